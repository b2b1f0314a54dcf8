"""Text to rows: entity phrases, gazetteer names, dates and dated events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions.defaults import MONTHS
from corpusgraph.functions.scale import cut, once, top_k
from corpusgraph.functions.text import EDGE, UNEVEN, WS, last_word, squeeze, trim_blanks

_ASCII = (r"[A-Z][a-zA-Z'’-]+", "[A-Z]")
_UNICODE = (r"\p{Lu}[\p{L}\p{M}'’-]+", r"\p{Lu}")
_UNICODE_EDGE = r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"


def phrase_pattern(unicode: bool = False) -> str:
    """Two to four capitalised words, lower-case connectors allowed between them."""
    word, initial = _UNICODE if unicode else _ASCII
    start, edge = (r"(?<![\p{L}\p{N}_])", _UNICODE_EDGE) if unicode else (r"(?<!\w)", EDGE)
    more = f"(?:{WS}+(?:(?:of|the|de|von|van|for){WS}+)?{word}){{1,3}}"
    return rf"{start}{word}(?:\.{initial})?{more}{edge}"


def phrase_candidates(docs: DataFrame, word_rules: DataFrame, unicode: bool = False) -> DataFrame:
    """doc_id, name: distinct title-case phrases that pass the word rules."""

    def words(*rules: str) -> Column:
        # Word lists are configuration: one small array each.
        return word_rules.filter(F.col("rule").isin(*rules)).agg(F.collect_set("word")).scalar()

    found = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(phrase_pattern(unicode)), F.lit(0)))).alias("raw"))
    name = F.regexp_replace(squeeze(F.col("raw")), r"[.,;:'’]+$", "")
    name = F.regexp_replace(name, r"(?i)['’]s$", "")
    named = once(found.select("doc_id", name.alias("name")), w=F.split("name", " "))
    named = (
        named.withColumn("weekdays", words("weekday"))
        .withColumn("calendar", words("weekday", "month"))
        .withColumn("stops", words("stop_first", "weekday", "month"))
        .withColumn("rejects", words("reject_any"))
    )
    plain = F.filter("w", lambda x: ~F.array_contains(F.col("calendar"), x) & ~x.rlike(r"^\d+$"))
    return (
        named.filter(F.size("w") >= 2)
        .filter(~F.array_contains(F.col("stops"), F.col("w")[0]))
        .filter(~F.arrays_overlap("w", "rejects"))
        .filter(F.size(plain) > 0)
        .filter(~(F.arrays_overlap("w", "weekdays") & (F.size("w") <= 2)))
        .select("doc_id", "name")
        .distinct()
    )


_PIECE = r"\w+|\W+"


def gazetteer_mentions(docs: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """doc_id, name: whole-word gazetteer hits (`case_sensitive` per name).

    Text is cut at word edges; a whole-word hit is a run of pieces equal to
    the name, so matching is an equi-join whatever the gazetteer size.
    """
    names = cut(
        gazetteer.select(
            "name",
            "case_sensitive",
            F.lower("name").alias("_key"),
            F.size(F.regexp_extract_all("name", F.lit(_PIECE), F.lit(0))).alias("_n"),
            F.col("name").rlike(r"^\w").alias("_word"),
        )
    )
    # The distinct shapes of configured names: a handful of rows.
    shapes = sorted((r["_n"], r["_word"]) for r in names.select("_n", "_word").distinct().collect())
    pieces = docs.select("doc_id", F.regexp_extract_all("text", F.lit(_PIECE), F.lit(0)).alias("_p"))
    # A run at either end of the text counts only if that end is a word.
    inner = once(pieces, _q=F.expr(r"filter(_p, (x, i) -> x rlike '\\w' OR (i > 0 AND i < size(_p) - 1))"))
    inner = once(inner.select("doc_id", "_q"), _w=F.when(F.get("_q", F.lit(0)).rlike(r"\w"), 0).otherwise(1))
    runs = []
    for n, word in shapes:
        run = ", ".join(f"get(_q, i + {k})" for k in range(n))
        # Words and gaps alternate, so runs that open with a word start at every other piece.
        start = "_w" if word else "1 - _w"
        last = f"size(_q) - {n}"
        runs.append(
            F.expr(f"CASE WHEN {last} >= {start} THEN transform(sequence({start}, {last}, 2), i -> concat({run})) ELSE array() END")
        )
    found = F.array_distinct(F.flatten(F.array(*runs))) if runs else F.array().cast("array<string>")
    keyed = inner.select("doc_id", F.explode(found).alias("_gram")).withColumn("_key", F.lower("_gram"))
    hits = keyed.join(names, "_key").filter(~F.col("case_sensitive") | (F.col("_gram") == F.col("name")))
    return hits.select("doc_id", "name").distinct()


def entity_df(mentions: DataFrame, gazetteer: DataFrame, min_doc_freq: int = 4) -> DataFrame:
    """name, n_docs of names in the gazetteer or seen in at least `min_doc_freq` documents."""
    freq = mentions.select("doc_id", "name").distinct().groupBy("name").agg(F.count("*").alias("n_docs"))
    known = gazetteer.select("name", F.lit(True).alias("_known")).distinct()
    return (
        freq.join(known, "name", "left")
        .filter((F.col("n_docs") >= min_doc_freq) | F.col("_known"))
        .select("name", "n_docs")
    )


def kept_mentions(mentions: DataFrame, kept: DataFrame) -> DataFrame:
    return mentions.join(kept.select("name"), "name", "left_semi")


# ── dates ────────────────────────────────────────────────────────────────────

_MONTH = "(" + "|".join(MONTHS) + ")"
# Three letters tell the months apart.
_STARTS = "".join(m[:3].lower() for m in MONTHS)
# Most places fail at their first letter, before any month is tried.
_INITIAL = "(?=[" + "".join(sorted({m[0] for m in MONTHS})) + "])"
# Next to a word character an ASCII word edge is one look-around.
LONG_DATE = rf"(?i){_INITIAL}(?<!\w){_MONTH}{WS}+(\d{{1,2}}),?{WS}+(\d{{4}})(?!\w)"
MONTH_YEAR = rf"(?i){_INITIAL}(?<!\w){_MONTH}{WS}+(\d{{4}})(?!\w)"
# Either form with a month's name: where one starts the other cannot.
_NAMED_DATE = rf"(?i){_INITIAL}(?<!\w){_MONTH}{WS}+(?:\d{{1,2}},?{WS}+)?\d{{4}}(?!\w)"
SLASH_DATE = r"(?=\d)(?<!\w)(\d{1,2})/(\d{1,2})/(\d{4})(?!\w)"
YEAR = r"(?<!\w)(\d{4})(?!\w)"


def _month_number(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), F.lower(name)).cast("int")


def _part(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 1)


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws(
        "-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")
    )


def _in_years(year: Column, min_year: int, max_year: int | None) -> Column:
    return year >= min_year if max_year is None else year.between(min_year, max_year)


def extract_dates(docs: DataFrame, min_year: int = 1980, max_year: int | None = None) -> DataFrame:
    """doc_id, dates (ISO strings) and years, both distinct and sorted; later years than `max_year`, if given, go.

    Day numbers up to 31 are accepted in every month, so dates stay strings.
    """

    def matches(pattern: str) -> Column:
        return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))

    def in_years(year: Column) -> Column:
        return _in_years(year, min_year, max_year)

    def dated(month: Column, day: Column, year: Column) -> Column:
        d, y = day.cast("int"), year.cast("int")
        return F.when(in_years(y) & d.between(1, 31) & month.between(1, 12), _iso(y, month, d))

    def long_date(m: Column) -> Column:
        return dated(_month_number(_part(m, r"^(\w+)")), _part(m, r"(\d+),?\D"), _part(m, r"(\d+)$"))

    def slash_date(m: Column) -> Column:
        return dated(_part(m, r"^(\d+)").cast("int"), _part(m, r"/(\d+)/"), _part(m, r"(\d+)$"))

    dates = F.array_compact(
        F.concat(F.transform(matches(LONG_DATE), long_date), F.transform(matches(SLASH_DATE), slash_date))
    )
    # Every accepted date and every month-year holds its year as a bare number.
    years = F.filter(F.transform(matches(YEAR), lambda m: m.cast("int")), in_years)
    return docs.filter("text IS NOT NULL").select(
        "doc_id",
        F.array_sort(F.array_distinct(dates)).alias("dates"),
        F.array_sort(F.array_distinct(years)).alias("years"),
    )


# A character no text holds.
_MARK = "\uffff"
# What stands before a run of blanks is looked at where the run begins, not at every letter.
SENTENCE_END = rf"{WS}(?<=[.!?\"”’]{WS}){WS}*(?=[A-Z\"'“‘])"


def _cut_up(text: str) -> Column:
    # `split` compiles its pattern for every row unless it is one plain character.
    return F.split(F.regexp_replace(text, SENTENCE_END, _MARK), _MARK)


def sentences(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, pos, sentence (trimmed), and the columns `keep` of the document."""
    parts = docs.select("doc_id", *keep, F.posexplode(_cut_up("text")).alias("pos", "sentence"))
    return once(parts.withColumnRenamed("sentence", "_s"), sentence=trim_blanks(F.col("_s"))).drop("_s")


def _named_parts(found: Column, digits: Column) -> Column:
    """m, d, y of a date found by its month's name, whose digits are those of the day, if it has one, and of the year."""
    year = F.right(digits, F.lit(4))
    month = F.floor((F.position(F.lower(F.left(found, F.lit(3))), F.lit(_STARTS)) + 2) / 3)
    day = F.when(F.length(digits) > 4, F.substring(digits, F.lit(1), F.length(digits) - 4).try_cast("int")).otherwise(1)
    return F.when(found != "", F.struct(month.cast("int").alias("m"), day.alias("d"), year.try_cast("int").alias("y")))


def _first_date(rows: DataFrame, s: str, min_year: int, max_year: int | None) -> DataFrame:
    """Add iso, display, precision of the earliest valid date in column `s`; rows without one go.

    Only the first match of each form is considered.
    """
    forms = {"_long": LONG_DATE, "_slash": SLASH_DATE, "_month": MONTH_YEAR}
    text, digits = F.col(s), F.regexp_replace("_named", r"\D+", "")
    # A slash date needs a slash; the first of both forms with a month's name comes from one search.
    rows = once(rows, _slash=F.when(F.contains(text, F.lit("/")), F.regexp_extract(s, SLASH_DATE, 0)).otherwise(""), _named=F.regexp_extract(s, _NAMED_DATE, 0))
    rows = rows.filter("_named <> '' OR _slash <> ''")
    rows = once(rows, _named_date=_named_parts(F.col("_named"), digits))

    def valid(date: Column) -> Column:
        return date["m"].between(1, 12) & date["d"].between(1, 31) & _in_years(date["y"], min_year, max_year)

    # Only behind one that is no date may the first of the other form count.
    first, day = valid(F.col("_named_date")), F.length(digits) > 4
    other = F.when((F.col("_named") != "") & ~first, F.when(day, F.regexp_extract(s, MONTH_YEAR, 0)).otherwise(F.regexp_extract(s, LONG_DATE, 0))).otherwise("")
    rows = once(rows, _day=day, _other=other)
    rows = once(rows, _other_date=F.when(F.col("_other") != "", _named_parts(F.col("_other"), F.regexp_replace("_other", r"\D+", ""))))
    pieces = [F.split_part("_slash", F.lit("/"), F.lit(n)).try_cast("int") for n in (1, 2, 3)]
    rows = once(
        rows,
        _slash_date=F.when(F.col("_slash") != "", F.struct(*[c.alias(k) for k, c in zip("mdy", pieces)])),
        _long_date=F.when(F.col("_day"), F.col("_named_date")).otherwise(F.col("_other_date")),
        _month_date=F.when(F.col("_day"), F.col("_other_date")).otherwise(F.col("_named_date")),
    )
    names = F.array(*[F.lit(m) for m in MONTHS])
    # Only where several forms occur does the place decide; else no pattern runs again.
    several = ((F.col("_slash") != "") & (F.col("_named") != "")) | (F.col("_other") != "")

    def candidate(name: str) -> Column:
        date = F.col(f"{name}_date")
        at = F.when(several, F.regexp_instr(s, F.lit(forms[name]))).otherwise(0)
        # Two forms never start at one place, so the place alone decides.
        return F.when(valid(date), F.struct(at.alias("at"), F.lit(name == "_month").alias("coarse"), *[date[k].alias(k) for k in "mdy"]))

    rows = once(rows, _first=F.least(*[candidate(n) for n in forms])).filter("_first IS NOT NULL")
    rows = rows.drop("_slash", "_named", "_other", "_day", "_named_date", "_other_date", "_slash_date", "_long_date", "_month_date")
    m, d, y = (F.col(f"_first.{k}") for k in "mdy")
    day = F.when(F.col("_first.coarse"), " ").otherwise(F.concat(F.lit(" "), d.cast("string"), F.lit(", ")))
    display, precision = F.concat(F.get(names, m - 1), day, y.cast("string")), F.when(F.col("_first.coarse"), "month").otherwise("day")
    return once(rows, iso=_iso(y, m, d), display=display, precision=precision).drop("_first")


def _description(s: Column, length: int | None) -> Column:
    text = F.ltrim(F.regexp_replace(s, UNEVEN, " "), F.lit(" \"'“‘-–—•"))
    if length is None:
        return F.trim(text)
    text = F.substring(F.rtrim(text), 1, length)
    cut_off = F.regexp_replace(text, r" +[^ ]*$", "…")
    return F.trim(F.when(F.length(s) > length, cut_off).otherwise(text))


def _told_once(docs: DataFrame, shortest: int, keep: Sequence[str]) -> DataFrame:
    """doc_id, ev_pos, sentence, description and `keep`: sentences that may hold a date, equal descriptions in a document once."""
    parts = F.transform(_cut_up("text"), lambda s, i: F.struct(i.alias("at"), trim_blanks(s).alias("s")))
    # A cheap test first: a date needs a digit.
    parts = F.filter(parts, lambda x: (F.length(x["s"]) >= shortest) & x["s"].rlike(r"\d{4}"))
    rows = once(docs.select("doc_id", "text", *keep), _said=parts).drop("text").filter(F.size("_said") > 0)
    told = F.transform("_said", lambda x: F.struct(x["at"].alias("at"), x["s"].alias("s"), _description(x["s"], None).alias("d")))
    rows = once(rows, _told=told).drop("_said")
    keyed = F.filter(F.transform("_told", lambda x: F.struct(F.lower(x["d"]).alias("k"), x["at"].alias("at"), x["s"].alias("s"), x["d"].alias("d"))), lambda x: F.length(x["d"]) >= shortest)
    # Only where some repeat: sorted, so repeats stand side by side, the first sentence in front.
    rows = once(rows, _k=keyed).drop("_told")
    rows = once(rows, _several=F.size(F.array_distinct("_k.k")) < F.size("_k"))
    rows = once(rows, _s=F.when(F.col("_several"), F.array_sort("_k")).otherwise(F.col("_k"))).drop("_k")
    first = F.when(F.col("_several"), F.filter("_s", lambda x, i: (i == 0) | (F.get("_s", i - 1)["k"] != x["k"]))).otherwise(F.col("_s"))
    rows = rows.select("doc_id", *keep, F.explode(first).alias("_e"))
    return rows.select("doc_id", F.col("_e.at").alias("ev_pos"), F.col("_e.s").alias("sentence"), F.col("_e.d").alias("description"), *keep)


def extract_events(
    docs: DataFrame, min_year: int = 1980, max_year: int | None = None,
    shortest: int = 1, length: int | None = None, head: int | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, ev_pos, iso, display, precision, description: one dated event per dated sentence.

    `docs` has one row a document, whose columns `keep` go with its events. By default nothing is cut or dropped. For
    short lists, sentences and descriptions of fewer than `shortest` letters go, descriptions end after `length`
    letters, and equal first `head` letters on one day count as one event.
    """
    columns = ["doc_id", "ev_pos", "iso", "display", "precision", "description", *keep]
    if head is None and length is None:
        # Equal descriptions have equal dates: a document's repeats go inside its row, and no event is shuffled.
        rows = _first_date(_told_once(docs, shortest, keep), "sentence", min_year, max_year)
        return rows.select(columns)
    long_enough = sentences(docs, keep).filter(F.length("sentence") >= shortest)
    # A cheap test first: a date needs a digit.
    dated = long_enough.filter(F.col("sentence").rlike(r"\d{4}"))
    events = once(_first_date(dated, "sentence", min_year, max_year), description=_description(F.col("sentence"), length))
    opening = F.col("description") if head is None else F.substring("description", 1, head)
    events = events.filter(F.length("description") >= shortest).select(
        "doc_id",
        F.col("pos").alias("ev_pos"),
        "iso",
        "display",
        "precision",
        "description",
        *keep,
        F.lower(opening).alias("_head"),
    )
    return top_k(events, ["doc_id", "iso", "_head"], [F.col("ev_pos")], 1, "_rn").drop("_head", "_rn")


def events_naming(docs: DataFrame, words: str, min_year: int = 1980, max_year: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """As `extract_events`, only events whose description holds one of the document's lower-case `words`; repeats stay.

    Dates are looked for in those sentences only.
    """

    def holds(text: Column, sought: str) -> Column:
        return F.exists(sought, lambda w: F.contains(text, w))

    # A description has its sentence's words, if not its blanks: the last of a phrase is in the sentence too.
    known = once(docs.select("doc_id", "text", words, *[c for c in keep if c != words]), _last=F.transform(words, last_word))
    parts = known.select("doc_id", words, "_last", *[c for c in keep if c != words], F.posexplode(_cut_up("text")).alias("ev_pos", "sentence"))
    # Cheap tests first: a date needs a digit.
    parts = parts.filter(F.col("sentence").rlike(r"\d{4}") & holds(F.lower("sentence"), "_last"))
    told = once(parts.drop("_last"), description=_description(F.col("sentence"), None))
    named = told.filter((F.col("description") != "") & holds(F.lower("description"), words))
    rows = _first_date(named, "sentence", min_year, max_year)
    return rows.select("doc_id", "ev_pos", "iso", "display", "precision", "description", *keep)


def real_date(iso: Column) -> Column:
    """The event day as a DATE, null for days the calendar does not have."""
    return F.try_to_date(iso)
