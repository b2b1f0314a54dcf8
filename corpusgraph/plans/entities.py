"""Queries over names in text: phrases, gazetteer, frequency, resolution, hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.functions import defaults
from corpusgraph.functions.scale import paged
from corpusgraph.operators import extract as X
from corpusgraph.operators import resolve as R
from corpusgraph.plans import corpora as K
from corpusgraph.plans.registry import query

table = K.table

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys([*defaults.STOP_FIRST, *defaults.WEEKDAYS, *defaults.MONTHS]))
_REJECT = ", ".join(f"'{w}'" for w in dict.fromkeys(defaults.REJECT_ANY))
_CALENDAR = ", ".join(f"'{w}'" for w in [*defaults.WEEKDAYS, *defaults.MONTHS])
_DAYS = ", ".join(f"'{w}'" for w in defaults.WEEKDAYS)


@query(
    "phrase_candidates",
    rf"""SELECT DISTINCT doc_id, name FROM (SELECT doc_id, name, string_split(name, ' ') AS w FROM (
          SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(raw, '\s+', ' ', 'g'), '[.,;:''’]+$', ''), '(?i)[''’]s$', '') AS name FROM (
            SELECT doc_id, unnest(regexp_extract_all(text,
              '\b[A-Z][a-zA-Z''’-]+(?:\.[A-Z])?(?:\s+(?:of|the|de|von|van|for)\s+[A-Z][a-zA-Z''’-]+|\s+[A-Z][a-zA-Z''’-]+){{1,3}}\b')) AS raw FROM documents)))
        WHERE len(w) >= 2 AND w[1] NOT IN ({_STOP}) AND NOT list_has_any(w, [{_REJECT}])
          AND NOT len(list_filter(w, lambda x: x NOT IN ({_CALENDAR}) AND NOT regexp_matches(x, '^\d+$'))) = 0
          AND NOT (list_has_any(w, [{_DAYS}]) AND len(w) <= 2)""",
)
def phrase_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return X.phrase_candidates(K.documents(spark, sf), defaults.word_rules(spark))


def _gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Opening words of every benchmark text, two or three at a time."""
    words = table(spark, sf, "benchmark").select("item_id", F.regexp_extract_all("text", F.lit(r"\w+|\W+"), F.lit(0)).alias("p"))
    names = words.select(F.explode(F.array(F.concat_ws("", F.slice("p", 1, 3)), F.concat_ws("", F.slice("p", 1, 5)))).alias("name"))
    return names.distinct().withColumn("case_sensitive", F.length("name") % 2 == 0)


@query(
    "gazetteer_mentions",
    r"""WITH g AS (SELECT DISTINCT name, length(name) % 2 = 0 AS exact FROM (
          SELECT unnest([array_to_string(p[1:3], ''), array_to_string(p[1:5], '')]) AS name FROM (
            SELECT regexp_extract_all(text, '\w+|\W+') AS p FROM benchmark)))
        SELECT doc_id, name FROM documents JOIN g ON contains(lower(text), lower(name)) AND regexp_matches(text,
          CASE WHEN exact THEN '' ELSE '(?i)' END || '\b' || regexp_replace(name, '([.*+?^${}()|\[\]\\])', '\\\1', 'g') || '\b')""",
)
def gazetteer_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return X.gazetteer_mentions(K.documents(spark, sf), _gazetteer(spark, sf))


@query(
    "entity_doc_freq",
    """SELECT name, count(DISTINCT doc_id) AS n_docs FROM d_mentions GROUP BY name
        HAVING count(DISTINCT doc_id) >= 40 OR name IN (SELECT upper(left(r_name, 1)) || lower(substr(replace(r_name, ' ', ''), 2)) || 'a County' FROM region)""",
)
def entity_doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    gaz = table(spark, sf, "region").select(F.concat(F.initcap(F.replace("r_name", F.lit(" "), F.lit(""))), F.lit("a County")).alias("name"))
    return X.entity_df(K.mentions(spark, sf), gaz, 40)


@query(
    "kept_mentions",
    """SELECT doc_id, name, count(*) AS n FROM d_mentions WHERE name IN (
          SELECT name FROM d_mentions GROUP BY name HAVING count(DISTINCT doc_id) >= 40) GROUP BY 1, 2""",
)
def kept_mentions(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.mentions(spark, sf)
    kept = X.entity_df(rows, spark.createDataFrame([], "name string"), 40)
    return X.kept_mentions(rows, kept).groupBy("doc_id", "name").agg(F.count("*").alias("n"))


# ── resolution ───────────────────────────────────────────────────────────────


def _resolved(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The resolution chain over the derived mentions; overrides, programs and containment are empty here."""
    return R.resolve(
        K.mentions(spark, sf),
        spark.createDataFrame([], "name string, type string"),
        spark.createDataFrame([], "name string"),
        spark.createDataFrame([], "child string, parent string"),
    )


@query(
    "canonical_names",
    r"""SELECT DISTINCT name AS raw, regexp_replace(regexp_replace(name, '''s$', ''), '^(Dr|Judge|President)\.?\s+', '') AS name FROM d_mentions""",
)
def canonical_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = K.mentions(spark, sf).select(F.col("name").alias("raw")).distinct()
    return raw.select("raw", R.canonical_name(F.col("raw")).alias("name"))


@query("group_canonical", "SELECT name, n_docs, judge, first_pos FROM d_grouped")
def group_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return R.group_canonical(R.canonical_mentions(K.mentions(spark, sf)))


@query("entity_types", "SELECT name, type FROM d_typed")
def entity_types(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf)["typed"].select("name", "type")


@query("merge_variants", "SELECT name, target FROM d_merged")
def merge_variants(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf)["merged"].select("name", "target")


@query(
    "surname_merge",
    """SELECT name, target, 'alias' AS kind FROM d_single WHERE n = 1
        UNION ALL SELECT DISTINCT s.name, m.target, 'family' FROM d_single s JOIN d_merged m ON m.last = lower(s.name) WHERE n > 1""",
)
def surname_merge(spark: SparkSession, sf: str) -> DataFrame:
    r = _resolved(spark, sf)
    alias = r["surnames"].withColumn("kind", F.lit("alias"))
    return alias.unionByName(r["families"].select("name", F.col("member").alias("target"), F.lit("family").alias("kind")))


@query("alias_resolution", "SELECT name, target FROM d_alias")
def alias_resolution(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf)["alias"]


@query("doc_entity", "SELECT doc_id, name FROM d_resolved")
def doc_entity(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf)["doc_entity"]


_HIERARCHY = r"""SELECT e.name, CASE WHEN s.name IS NOT NULL THEN 'Families' ELSE t.type END AS type,
          coalesce(c.name, f.name) AS parent, e.n_docs
        FROM (SELECT name, count(*) AS n_docs FROM d_resolved GROUP BY 1) e JOIN d_typed t USING (name)
        LEFT JOIN (SELECT name FROM d_single WHERE n > 1) s ON s.name = e.name
        LEFT JOIN (SELECT m.target, arg_max(x.name, (x.first_pos, x.name)) AS name FROM d_single x JOIN d_merged m ON m.last = lower(x.name)
          WHERE x.n > 1 GROUP BY 1) f ON f.target = e.name
        LEFT JOIN (SELECT DISTINCT name FROM d_resolved) c ON c.name = regexp_extract(e.name, '^(.*\bCounty)\b.+(?:District Attorney|Sheriff|Court)', 1)"""


@query("hierarchy", _HIERARCHY)
def hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf)["entities"]


@query(
    "children",
    f"""SELECT parent, count(*) AS n, string_agg(name, '|' ORDER BY name) AS children FROM ({_HIERARCHY}) WHERE parent IS NOT NULL GROUP BY parent""",
)
def children(spark: SparkSession, sf: str) -> DataFrame:
    pages = paged(R.children(_resolved(spark, sf)["entities"]), ["parent"], [F.asc("child")], "child", 10_000, "children")
    return pages.select("parent", F.size("children").cast("long").alias("n"), F.array_join("children", "|").alias("children"))
