"""URL filter by rules and by a tree of path templates, in DataFrame functions only.

Rules over hosts and path prefixes decide first, the longest that fits. What no
rule decides is judged by where it stands in its host's tree of path templates:

- Level by level, a segment that few pages of its branch share is variable and
  becomes the wildcard `*`; common segments stay as branches.
- Branches of one parent whose labelled shares of bad pages do not differ
  statistically (two-proportion test) are merged, and so are their subtrees.
- The purity of a template is its share of bad among labelled pages, smoothed
  towards that of its parent, the host's towards that of all hosts. A page is
  rejected if its template has enough labelled pages and its purity is high.

A branch of the tree stands for at least `literal_percent` of its parent's
pages, so a parent has a bounded number of them, whatever the host's size. Page
rows of a hot host are counted before the shuffle and are never grouped.

Defined results: a null url, or one without `://`, has an empty host and path,
and the tree of that host judges it; paths deeper than `levels` are judged by
their first segments; null labels count as unlabelled; repeated rows count as
often as they occur; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusgraph.functions.scale import cut_light as cut, discard
from corpusgraph.llm.common import quoted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Fits the host and its subdomains where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Tree:
    """Bounds of the template tree."""

    levels: int = 4
    #: A segment stays a branch with at least this share of its parent's pages, and so many pages.
    literal_percent: int = 2
    literal_least: int = 3
    #: Branches with so many labelled pages may merge, if their shares are within so many standard errors.
    merge_least: int = 5
    merge_errors: float = 1.96
    #: Labelled pages that the parent's purity weighs as much as.
    strength: float = 5.0
    reject_least: int = 5
    reject_purity: float = 0.8


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end, A-Z lowered; empty if there is none."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    own = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.coalesce(F.when(at > 0, F.translate(own, UPPER, LOWER)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty if there is no host."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    own = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(at > 0, own), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does; equal lengths in the given order."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _grown(rows: DataFrame, level: int, tree: Tree) -> DataFrame:
    """Rows moved from the node of their parent to that of their branch at `level`, if they have a segment there."""
    segment = F.try_element_at("segments", F.lit(level))
    rows = rows.withColumn("segment", segment)
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    counts = rows.filter("segment IS NOT NULL").groupBy("node", "segment").agg(
        F.max("purity").alias("parent"), F.count("*").alias("n"), F.count("label").alias("labelled"), F.sum(F.coalesce(F.col("label").cast("long"), F.lit(0))).alias("bad")
    )
    counts = cut(counts)
    totals = counts.groupBy("node").agg(F.max("parent").alias("parent"), *sums)
    common = counts.filter(F.col("n") >= tree.literal_least).join(totals.select("node", F.col("n").alias("total")), "node")
    common = cut(common.filter(F.col("n") * 100 >= F.col("total") * tree.literal_percent).drop("total"))
    kept = common.groupBy("node").agg(*sums).select("node", *[F.col(c).alias(f"kept_{c}") for c in ("n", "labelled", "bad")])
    rest = totals.join(kept, "node", "left").select(
        "node", F.lit(None).cast("string").alias("segment"), "parent", *[(F.col(c) - F.coalesce(f"kept_{c}", F.lit(0))).alias(c) for c in ("n", "labelled", "bad")]
    )
    branches = common.select("node", "segment", "parent", "n", "labelled", "bad").unionByName(rest.filter("n > 0"))
    # At most 100 / literal_percent branches and the wildcard share a parent.
    siblings = W.partitionBy("node", "ready").orderBy("share", F.col("segment").asc_nulls_first())
    before = [F.lag(c).over(siblings) for c in ("labelled", "bad")]
    both, hits = F.col("labelled") + before[0], F.col("bad") + before[1]
    pooled = (hits + 1) / (both + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / before[0]))
    apart = F.col("share") - before[1] / before[0] > tree.merge_errors * error
    branches = branches.withColumn("ready", F.col("labelled") >= tree.merge_least)
    branches = branches.withColumn("share", F.when(F.col("ready"), F.col("bad") / F.col("labelled")))
    branches = branches.withColumn("new", F.when(F.col("ready"), F.coalesce(apart, F.lit(True))).otherwise(True).cast("int"))
    # Branches with too few labels stay on their own.
    branches = branches.withColumn("group", F.sum("new").over(siblings.rowsBetween(W.unboundedPreceding, 0)))
    whole = W.partitionBy("node", "ready", "group")
    # The marks of wildcards and merged branches cannot be taken for those of a segment.
    plain = F.regexp_replace("segment", r"([*|\\])", r"\\$1")
    named = F.array_join(F.array_sort(F.collect_list(F.coalesce(plain, F.lit("*"))).over(whole)), "|")
    bad, labelled = F.sum("bad").over(whole), F.sum("labelled").over(whole)
    branches = cut(branches.select(
        "node", "segment", F.concat_ws("/", "node", named).alias("next"), labelled.alias("n_labelled"),
        ((bad + tree.strength * F.col("parent")) / (labelled + tree.strength)).alias("next_purity"),
    ))
    literal = branches.filter("segment IS NOT NULL")
    star = branches.filter("segment IS NULL").select("node", *[F.col(c).alias(f"star_{c}") for c in ("next", "n_labelled", "next_purity")])
    found = rows.join(literal, ["node", "segment"], "left").join(star, "node", "left")
    moved = F.col("segment").isNotNull()

    def new(name: str, old: str) -> Column:
        return F.when(moved, F.coalesce(name, f"star_{name}")).otherwise(F.col(old)).alias(old)

    out = cut(found.select("row", "segments", "label", new("next", "node"), new("next_purity", "purity"), new("n_labelled", "labelled")))
    for used in (counts, common, branches):
        discard(used)
    return out


def templates(pages: DataFrame, host: Column, path: Column, label: Column, tree: Tree = Tree()) -> DataFrame:
    """Struct `row` with the page's columns, its template `node`, the template's smoothed `purity` and its `labelled` pages."""
    rows = cut(pages.select(
        F.struct(*quoted(pages.columns)).alias("row"), host.alias("node"), label.cast("boolean").alias("label"),
        F.slice(F.filter(F.split(path, "/"), lambda s: s != ""), 1, tree.levels).alias("segments"),
    ))
    counts = [F.count("label").alias("labelled"), F.sum(F.coalesce(F.col("label").cast("long"), F.lit(0))).alias("bad")]
    hosts = rows.groupBy("node").agg(*counts)
    # One row: the share over all hosts.
    overall = hosts.agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
    prior = ((overall["bad"] or 0) + 1) / ((overall["labelled"] or 0) + 2)
    smoothed = (F.col("bad") + tree.strength * F.lit(prior)) / (F.col("labelled") + tree.strength)
    current = cut(rows.join(hosts.select("node", smoothed.alias("purity"), "labelled"), "node"))
    discard(rows)
    for level in range(1, tree.levels + 1):
        grown = _grown(current, level, tree)
        discard(current)
        current = grown
    return current.select("row", "node", "purity", "labelled")


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], *, url: str = "url", label: str | None = None, tree: Tree = Tree(), into: str = "judged"
) -> DataFrame:
    """The pages with a struct `into`: host, path, rule, verdict, template, purity; a column of that name is replaced.

    Labelled are the pages that a rule decides and, where `label` names a column (true: bad), those it is not null for.
    """
    keep = [c for c in pages.columns if c != into]
    own = F.col(f"`{url}`").cast("string")
    found = F.struct(host_of(own).alias("host"), path_of(own).alias("path"))
    given = F.lit(None).cast("boolean") if label is None else F.col(f"`{label}`").cast("boolean")
    parsed = pages.select(F.struct(*quoted(keep)).alias("kept"), found.alias("url"), given.alias("given"))
    parsed = parsed.withColumn("rule", rule_of(F.col("url.host"), F.col("url.path"), rules))
    known = F.coalesce(F.col("rule.verdict") == BLOCK, F.col("given"))
    judged = templates(parsed, F.col("url.host"), F.col("url.path"), known, tree)
    rejected = (F.col("labelled") >= tree.reject_least) & (F.col("purity") >= tree.reject_purity)
    verdict = F.coalesce("row.rule.verdict", F.when(rejected, BLOCK).otherwise(ALLOW))
    return judged.select("row.kept.*", F.struct(
        F.col("row.url.host").alias("host"), F.col("row.url.path").alias("path"), F.col("row.rule.rule").alias("rule"), verdict.alias("verdict"),
        F.col("node").alias("template"), "purity",
    ).alias(into))
