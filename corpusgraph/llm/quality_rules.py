"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (0) or abstains (null) on a document. Expectation
maximisation over the counts of vote patterns estimates how often each rule is
right on good and on bad documents, and the share of good ones; a document's
posterior probability of being good then decides, not a demand that every rule
pass. The pattern table has at most 3 ** (number of rules) rows, whatever the
size of the corpus; a round reads it with one aggregate.

Defined results: a null or empty text has no words, gets no votes and fails the
base test; statistics are per row, so repeated rows repeat; no documents give
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions.scale import cut_light as cut, once

# Single characters below 256 make the fastest classes, ranges do not.
BLANK = r"[ \t\n\x0B\f\r]"
SYMBOLS = "[#*$%&|<>]+"
_UPPER = "".join(chr(c) for c in (*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)))
CAPITALS = f"[{_UPPER}]+"
#: All that is not counted one by one: other characters are taken out in one pass.
MARKS = f"[^#*$%&|<>!.{_UPPER}]+"

#: Base test: fewer words than this, or more than half of them in repeated windows.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains; both are SQL over the statistics."""

    name: str
    bad: str = "false"
    good: str = "false"


#: Each defect has a rule that only votes bad; good votes need prose of every measured kind.
RULES = (
    Rule("symbols", bad="n_symbols > 0.1 * n_words"),
    Rule("capitals", bad="n_capitals > 0.4 * word_chars"),
    Rule("shouting", bad="n_shouts > 0.3 * n_words"),
    Rule("unpunctuated", bad="n_stops < 0.02 * n_words"),
    Rule("repeats", bad="n_repeat_words > 0.3 * n_words"),
    Rule("lines", bad="n_dup_lines > 0.3 * n_lines"),
    Rule("word_length", bad="word_chars NOT BETWEEN 2 * n_words AND 12 * n_words"),
    Rule(
        "prose",
        good="n_symbols <= 0.02 * n_words AND n_capitals < 0.2 * word_chars AND n_shouts <= 0.05 * n_words AND n_stops >= 0.02 * n_words",
    ),
    Rule("fresh", good="n_symbols <= 0.02 * n_words AND n_repeat_words < 0.15 * n_words AND n_dup_lines <= 0.1 * n_lines"),
)


def _count(marks: Column, pattern: str) -> Column:
    return (F.length(marks) - F.length(F.regexp_replace(marks, pattern, ""))).cast("long")


def text_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Columns `keep` and a struct `stats` of counts over each whole text.

    Words in repeated windows are found inside the row: window hashes, with
    their places in the low bits, are sorted as plain numbers, neighbours with
    equal hashes are candidates, and only those are compared as strings.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "stats"]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), body.alias("_t"))
    trimmed = F.btrim("_t", F.lit(" \t\n\x0b\x0c\r"))
    rows = once(
        rows,
        _w=F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK + "+")),
        _lines=F.filter(F.split("_t", "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]")),
        _marks=F.regexp_replace("_t", MARKS, ""),
    ).drop("_t")

    size = F.size("_w")
    rows = rows.withColumn("_bits", F.length(F.bin(size.cast("long")))).withColumn("_high", F.expr("shiftleft(-1L, _bits)"))

    def keyed(w: Column, i: Column) -> Column:
        window = F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))
        # The last two words begin no window.
        return F.when(i < size - 2, window.bitwiseAND(F.col("_high")).bitwiseOR(i.cast("long")))

    rows = once(rows, _keys=F.sort_array(F.transform("_w", keyed), asc=False))

    def as_next(k: Column, j: Column) -> Column:
        return k.bitwiseXOR(F.get("_keys", j + 1)).bitwiseAND(F.col("_high")) == 0

    def spelled(j: Column) -> Column:
        at = F.get("_keys", j).bitwiseAND(F.bitwise_not(F.col("_high"))).cast("int")
        return F.struct(F.array_join(F.slice("_w", at + 1, 3), " ").alias("g"), at.alias("at"))

    # Strings are made only for keys that agree with the next one, and for that next one.
    agree = F.filter(F.transform("_keys", lambda k, j: F.when(as_next(k, j), j)), lambda j: j.isNotNull())
    rows = once(rows, _agree=agree)
    both = F.array_distinct(F.flatten(F.transform("_agree", lambda j: F.array(j, j + 1))))
    rows = once(rows, _same=F.sort_array(F.transform(both, spelled))).drop("_keys", "_agree", "_bits", "_high")

    def repeated(x: Column, j: Column) -> Column:
        return F.coalesce(x["g"] == F.get("_same", j - 1)["g"], F.lit(False)) | F.coalesce(
            x["g"] == F.get("_same", j + 1)["g"], F.lit(False)
        )

    covered = F.flatten(F.transform(F.filter("_same", repeated), lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))
    stats = F.struct(
        size.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        _count(F.col("_marks"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(F.array_distinct(covered)), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        _count(F.col("_marks"), CAPITALS).alias("n_capitals"),
        _count(F.col("_marks"), "!+").alias("n_shouts"),
        _count(F.col("_marks"), "[.]+").alias("n_stops"),
    )
    return rows.select("_row.*", stats.alias("stats"))


def base_failed(stats: str = "stats") -> Column:
    words, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * words)


def votes(rules: Sequence[Rule] = RULES, stats: str = "stats") -> Column:
    """Array with one vote per rule: 1, 0 or null; documents without words get no votes."""

    def vote(rule: Rule) -> Column:
        bad, good = (F.expr(_qualified(sql, stats)) for sql in (rule.bad, rule.good))
        return F.when(F.col(f"{stats}.n_words") == 0, None).when(bad, 0).when(good, 1).cast("tinyint")

    return F.array(*[vote(r) for r in rules])


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_shouts", "n_stops")


def _qualified(sql: str, stats: str) -> str:
    return " ".join(f"{stats}.{w}" if w in _FIELDS else w for w in sql.split(" "))


#: What a rule can say of a document: 1 good, 0 bad, 2 nothing.
SAYS = (1, 0, 2)


@dataclass(frozen=True)
class Model:
    """Share of good documents; per rule, how often it says good, bad and nothing of good and of bad ones."""

    prior: float
    of_good: tuple[tuple[float, ...], ...]
    of_bad: tuple[tuple[float, ...], ...]

    def posterior(self, cast: Column) -> Column:
        """Probability that a document with these votes is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for j, (good, bad) in enumerate(zip(self.of_good, self.of_bad, strict=True)):
            weight = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
            vote = F.get(cast, F.lit(j))
            odds = odds + F.when(vote == 1, weight[0]).when(vote == 0, weight[1]).otherwise(weight[2])
        return 1 / (1 + F.exp(-odds))

    def accuracies(self) -> list[tuple[float, float]]:
        """Per rule: how often its good votes and its bad votes are right."""
        p, out = self.prior, []
        for good, bad in zip(self.of_good, self.of_bad, strict=True):
            out.append((p * good[0] / (p * good[0] + (1 - p) * bad[0]), (1 - p) * bad[1] / (p * good[1] + (1 - p) * bad[1])))
        return out


def estimate(patterns: DataFrame, n_rules: int, rounds: int = 10, prior: float = 0.8) -> Model:
    """Expectation maximisation over (votes, n), every count smoothed by one.

    Abstaining counts as an answer, since on what a rule keeps silent tells something too.
    """
    model = Model(prior, ((0.6, 0.1, 0.3),) * n_rules, ((0.1, 0.6, 0.3),) * n_rules)
    patterns = cut(patterns.coalesce(1))
    total = patterns.agg(F.sum("n")).first()[0] or 0
    for _ in range(rounds if total else 0):
        weighed = once(patterns, good=F.col("n") * model.posterior(F.col("votes")))
        each = weighed.select("n", "good", F.posexplode("votes").alias("rule", "vote"))
        sums = []
        for says in SAYS:
            own = F.coalesce("vote", F.lit(2)) == says
            sums += [F.sum(F.when(own, F.col("good")).otherwise(0.0)).alias(f"good{says}")]
            sums += [F.sum(F.when(own, F.col("n") - F.col("good")).otherwise(0.0)).alias(f"bad{says}")]
        found = {r["rule"]: r for r in each.groupBy("rule").agg(*sums).collect()}

        def rates(kind: str, found: dict = found) -> tuple[tuple[float, ...], ...]:
            counts = [[found[j][f"{kind}{says}"] + 1 for says in SAYS] for j in range(n_rules)]
            return tuple(tuple(x / sum(c) for x in c) for c in counts)

        good = sum(found[0][f"good{says}"] for says in SAYS)
        model = Model((good + 1) / (total + 2), rates("good"), rates("bad"))
    return model


def judge(
    docs: DataFrame, *, text: str = "text", keep: Sequence[str] | None = None, rules: Sequence[Rule] = RULES, rounds: int = 10,
    threshold: float = 0.5,
) -> DataFrame:
    """Columns `keep`, then stats, votes, quality (posterior), base_failed and kept; columns of these names are replaced."""
    own = ("stats", "votes", "quality", "base_failed", "kept")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    voted = cut(text_statistics(docs, text, keep).withColumn("votes", votes(rules)))
    patterns = voted.filter("stats.n_words > 0").groupBy("votes").agg(F.count("*").alias("n"))
    quality = estimate(patterns, len(rules), rounds).posterior(F.col("votes"))
    out = voted.select(*[F.col(f"`{c}`") for c in keep], "stats", "votes", quality.alias("quality"), base_failed().alias("base_failed"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
