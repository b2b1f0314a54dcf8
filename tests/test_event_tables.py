"""The event index on disk, its map form, and event lists by year."""

from pyspark.sql import functions as F

from corpusgraph.operators import corpus as C
from corpusgraph.sources import tables as TB


def test_a_lookup_skips_row_groups(spark, tmp_path):
    index = spark.range(40_000).select(
        F.concat(F.element_at(F.array(F.lit("Cases/"), F.lit("People/")), (F.col("id") % 2 + 1).cast("int")), F.lpad((F.col("id") / 20).cast("int").cast("string"), 6, "0"), F.lit(".md")).alias("path"),
        (F.col("id") % 20).alias("rank"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("description"),
    )
    TB.write_event_index(index, str(tmp_path / "ix"), row_group=64 << 10)
    found = TB.read_note_events(spark, str(tmp_path / "ix"), "People/000101.md", "Cases/000007.md", "Nowhere/x.md")
    assert {(r.path, r["rank"]) for r in found.collect()} == {("People/000101.md", k) for k in range(1, 20, 2)} | {("Cases/000007.md", k) for k in range(0, 20, 2)}
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [In(path" in plan.toString() and "PartitionFilters: [folder" in plan.toString()
    scan = plan.collectLeaves().head()
    read = scan.metrics().apply("numOutputRows").value()
    assert 20 <= read < 20_000


def test_event_map_is_paged_by_note(spark, tmp_path):
    rows = [("Cases/a.md", k, f"2020-01-0{k}", "d", "day", f"text {k}", "s") for k in (3, 1, 2)] + [("top.md", 1, "2021", "d", "year", "t", "s")]
    index = spark.createDataFrame(rows, "path string, rank long, iso string, display string, precision string, description string, source string")
    TB.write_event_map(C.event_map(index, 2), str(tmp_path / "map"))
    pages = {(r.path, r.page): [e.description for e in r.events] for r in TB.read_event_map(spark, str(tmp_path / "map"), "Cases").collect()}
    assert pages == {("Cases/a.md", 0): ["text 1", "text 2"], ("Cases/a.md", 1): ["text 3"]}
    assert TB.read_event_map(spark, str(tmp_path / "map"), "top.md").count() == 1


def test_events_in_years(spark):
    rows = [("c", 1, 0, "2020-05-01", "b"), ("c", 2, 0, "2020-01-01", "a"), ("c", 1, 1, "2019-12-31", "z"), ("d", 1, 0, "2020-01-01", "q"), ("c", 3, 0, "2020-05-01", "c")]
    timeline = spark.createDataFrame(rows, "case string, doc_id long, ev_pos int, iso string, description string")
    timeline = timeline.selectExpr("*", "'d' AS display", "'day' AS precision", "'n' AS note")
    got = {(r.case, r.year, r.page): [e.description for e in r.events] for r in C.events_in_years(timeline, 2).collect()}
    assert got == {("c", "2020", 0): ["a", "b"], ("c", "2020", 1): ["c"], ("c", "2019", 0): ["z"], ("d", "2020", 0): ["q"]}
