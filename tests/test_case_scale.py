"""Case steps move texts no more than needed; results are checked against plain rules."""

from pyspark.sql import functions as F

from corpusgraph.functions import scale
from corpusgraph.functions.scale import contains_join, ranked
from corpusgraph.operators import corpus as C
from corpusgraph.operators import extract as X


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_events_of_a_document_are_told_once_without_a_shuffle(spark):
    text = 'Met on May 1, 2019. "met  on May 1, 2019. Met on May 2, 2019. MET on May 1, 2019.'
    found = X.extract_events(spark.createDataFrame([(1, text, "n")], "doc_id long, text string, note string"), keep=["note"])
    assert [(r.ev_pos, r.iso, r.note) for r in found.orderBy("ev_pos").collect()] == [(0, "2019-05-01", "n"), (2, "2019-05-02", "n")]
    assert "Exchange" not in _plan(found)


def test_case_events_with_note_and_day_need_no_articles(spark):
    events = spark.createDataFrame(
        [(1, 0, "2019-01-01", "Vale spoke, then Vale left.", "n1", "2019-02-01"), (1, 1, "2019-03-01", "Later.", "n1", "2019-02-01"), (2, 0, "2019-01-01", "Nothing.", "n2", "2019-02-01")],
        "doc_id long, ev_pos int, iso string, description string, note string, published_at string",
    ).withColumn("display", F.col("iso")).withColumn("precision", F.lit("day"))
    members = spark.createDataFrame([("A", 1, "entity"), ("B", 1, "category"), ("A", 2, "entity")], "case string, doc_id long, strength string")
    words = spark.createDataFrame([("A", "vale"), ("A", "spoke"), ("B", "vale")], "case string, keyword string")
    kept = C.case_events(members, events, None, words)
    assert sorted((r["case"], r.doc_id, r.ev_pos) for r in kept.collect()) == [("A", 1, 0), ("B", 1, 0)]


def test_many_patterns_give_the_same_rows_as_few(spark, monkeypatch):
    left = spark.createDataFrame([(i, "a", f"word{i} Überfluß x{i}y zz") for i in range(40)], "id int, k string, t string")
    right = spark.createDataFrame([("a", p) for p in ("word1", "x3", "z", " ", "", "fluß x7y")] + [("b", "word2")], "k string, p string")
    few = sorted((r.id, r.p) for r in contains_join(left, "t", right, "p", ["k"]).collect())
    monkeypatch.setattr(scale, "_FEW", 0)
    assert few == sorted((r.id, r.p) for r in contains_join(left, "t", right, "p", ["k"]).collect())
    assert few == sorted((i, p) for i in range(40) for p in ("word1", "x3", "z", " ", "fluß x7y") if p in f"word{i} Überfluß x{i}y zz")


def test_ranks_are_given_where_rows_are_sorted(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = ranked(rows, ["g"], [F.desc("v")])
    assert {(r.g, r.v): r.rank for r in out.collect()} == {(i % 3, i): (max(j for j in range(500) if j % 3 == i % 3) - i) // 3 + 1 for i in range(500)}
    assert "Window" not in _plan(out)


def test_tag_pairs_count_sets_as_they_lie_in_rows(spark):
    from corpusgraph.operators import tags as A

    many = [f"t{i:04d}" for i in range(600)]
    lists = [["a", "b", "a"], ["b", "a", None], ["a", "b", "c"], None, [], ["a"], ["c", "b"], many, many[:3]]
    nodes = spark.createDataFrame([(f"n{i}", t) for i, t in enumerate(lists)], "id string, tags array<string>")
    found = {(r.tag_a, r.tag_b): r.shared for r in A.tag_pairs(nodes, 2).collect()}
    assert found == {("a", "b"): 3, ("b", "c"): 2, ("t0000", "t0001"): 2, ("t0000", "t0002"): 2, ("t0001", "t0002"): 2}
    top = spark.createDataFrame([("a",), ("b",)], "tag string")
    plan = A.tag_pairs(nodes, 1, only=top)
    assert [tuple(r) for r in plan.collect()] == [("a", "b", 3)]


def test_closed_folders_are_one_small_table(spark):
    from corpusgraph.operators import graph as G

    nodes = spark.createDataFrame([(f"x{i}", "big") for i in range(50)] + [("y", "open"), ("z", None)], "id string, folder string")
    centres = spark.createDataFrame([("big", "x7"), ("open", "y")], "folder string, id string")
    shut = spark.createDataFrame([("big",), ("none",)], "folder string")
    shown = G.collapse(nodes, centres, shut)
    assert sorted(r.id for r in shown.collect()) == ["x7", "y", "z"]
    assert "BroadcastHashJoin" in _plan(shown) and "SortMergeJoin" not in _plan(shown)
