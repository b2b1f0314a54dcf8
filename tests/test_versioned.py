"""Tables changed batch by batch: one row per key, retried batches, late rows, no history."""

import pytest
from pyspark.sql import functions as F

from corpusgraph.sources.versioned import VersionedTable
from corpusgraph.streaming import jobs as J


def _keep_new(rows, delta):
    return rows.join(delta.select("k"), "k", "left_anti").unionByName(delta)


def test_batches_replace_only_touched_buckets(spark, tmp_path, rows):
    schema = "k long, v string"
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    with pytest.raises(ValueError):
        table.read()
    table.create(spark.createDataFrame([], schema).schema, ["k"], 8)
    assert table.read().count() == 0
    assert table.apply(spark.createDataFrame([(i, "a") for i in range(50)], schema), 0, _keep_new)
    before = dict(table.manifest()["at"])
    assert table.apply(spark.createDataFrame([(7, "b")], schema), 1, _keep_new)
    after = table.manifest()["at"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    # The same batch again changes nothing, and another source has its own numbers.
    assert not table.apply(spark.createDataFrame([(7, "z")], schema), 1, _keep_new)
    assert table.apply(spark.createDataFrame([(99, "c")], schema), 0, _keep_new, "other")
    assert table.apply(spark.createDataFrame([], schema), 2, _keep_new)
    want = sorted([(i, "a") for i in range(50) if i != 7] + [(7, "b"), (99, "c")], key=repr)
    assert rows(table.read()) == want
    held = len(table.read().inputFiles())
    assert held == 8 and table.vacuum() == 2 and rows(table.read()) == want and table.vacuum() == 0
    # create() leaves a table as it is.
    assert rows(table.create(table.read().schema, ["k"], 3).read()) == want


def test_a_reader_sees_whole_batches(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([], "k long, v string").schema, ["k"], 4)
    table.apply(spark.createDataFrame([(1, "a"), (2, "a")], "k long, v string"), 0, _keep_new)
    early = table.read()

    def fails(old, delta):
        return old.unionByName(delta).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        table.apply(spark.createDataFrame([(1, "b")], "k long, v string"), 1, fails)
    assert rows(table.read()) == [(1, "a"), (2, "a")]
    assert table.apply(spark.createDataFrame([(1, "b")], "k long, v string"), 1, _keep_new)
    assert rows(table.read()) == [(1, "b"), (2, "a")] and rows(early) == [(1, "a"), (2, "a")]
    assert table.vacuum() >= 1 and rows(table.read()) == [(1, "b"), (2, "a")]  # the bucket of 1 and what the failure left


def test_late_rows_are_merged_and_counted(spark, tmp_path, rows):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    batches = [[("2024-01-01 10:00:00", "a"), ("2024-01-08 10:00:00", "a")], [("2024-01-01 11:00:00", "a"), ("2024-01-07 09:00:00", None)], [(None, "a"), ("2024-01-20 00:00:00", "b")]]
    for batch in batches:
        spark.createDataFrame(batch, "ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("ts timestamp, kind string").parquet(src)
        J.stream_daily(stream, "ts", "kind", "2 days", out, str(tmp_path / "state")).awaitTermination()
    got = J.window_counts(spark, out).select(F.to_date("start").cast("string"), "kind", "n", "late")
    # The second row of 1 January comes when the 6th is the watermark; the 7th is not behind it.
    assert rows(got) == sorted([("2024-01-01", "a", 2, 1), ("2024-01-07", None, 1, 0), ("2024-01-08", "a", 1, 0), ("2024-01-20", "b", 1, 0)], key=repr)


def test_upsert_stream_keeps_one_row_per_key(spark, tmp_path, rows):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for n, batch in enumerate([[(1, 5, "a"), (1, 5, "a2"), (2, 1, "b"), (None, 1, "n")], [(1, 4, "old"), (2, 1, "tie"), (3, 1, "c")]]):
        spark.createDataFrame(batch, "id long, at long, v string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("id long, at long, v string").parquet(src)
        J.stream_upsert(stream, out, "id", [F.desc("at")], str(tmp_path / "state"), buckets=2).awaitTermination()
        assert VersionedTable(spark, out).manifest()["version"] == n + 1
    got = {r.id: r.v for r in J.current(spark, out).collect()}
    assert got[1] in ("a", "a2") and got[2] == "tie" and got[3] == "c" and len(got) == 3
    assert len(J.current(spark, out).inputFiles()) <= 2
