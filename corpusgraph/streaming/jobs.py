"""Continuous upserts and live activity counts.

Every micro-batch is merged into a `VersionedTable`: one row per key or window
on disk, the same rows however often a batch is retried, and no history to
read. Rows that come late change the windows they belong to, whatever their
age; how many came behind the watermark is counted beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusgraph.functions.scale import top_k
from corpusgraph.sources.versioned import VersionedTable


def _start(source: DataFrame, apply, checkpoint: str, trigger: dict) -> StreamingQuery:
    stream = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()


def stream_upsert(
    source: DataFrame, target: str, key: str, order: list[Column], checkpoint: str, buckets: int = 16, **trigger
) -> StreamingQuery:
    """Keep the first row per key in `order` over all batches in the table at `target`; ties go to the later batch."""
    VersionedTable(source.sparkSession, target).create(source.schema, [key], buckets)

    def latest(rows: DataFrame, delta: DataFrame) -> DataFrame:
        both = rows.withColumn("_new", F.lit(0)).unionByName(delta.withColumn("_new", F.lit(1)))
        return top_k(both, [key], [*order, F.desc("_new")], 1, "_rn")

    def apply(batch: DataFrame, batch_id: int) -> None:
        # What one batch says of a key is settled before the table is read.
        first = top_k(batch.filter(F.col(key).isNotNull()), [key], order, 1, "_rn").drop("_rn")
        first = first.persist()
        try:
            VersionedTable(batch.sparkSession, target).apply(first, batch_id, latest, checkpoint)
        finally:
            first.unpersist()

    return _start(source, apply, checkpoint, trigger)


def current(spark: SparkSession, target: str) -> DataFrame:
    """The upserted table."""
    return VersionedTable(spark, target).read()


_COUNTS = T.StructType([
    T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType()), T.StructField("kind", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("late", T.LongType()),
])


def stream_trailing(
    source: DataFrame, ts: str, kind: str, watermark: str, target: str, checkpoint: str,
    length: str = "7 days", slide: str = "1 day", buckets: int = 16, **trigger,
) -> StreamingQuery:
    """Activity per kind over a trailing window: rows per window and kind, and how many of them came behind the watermark.

    The watermark is the latest time of all earlier batches less the interval `watermark`. A window that ended before it
    was final for readers that do not look back; its late rows are merged all the same.
    """
    VersionedTable(source.sparkSession, target).create(_COUNTS, ["start", "kind"], buckets)

    def merged(rows: DataFrame, delta: DataFrame) -> DataFrame:
        return rows.unionByName(delta).groupBy("start", "end", "kind").agg(F.sum("n").alias("n"), F.sum("late").alias("late"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, target)
        seen = table.manifest()["notes"].get("latest")
        behind = F.lit(False) if seen is None else F.col("w.end") <= F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
        known = batch.filter(F.col(ts).isNotNull())
        counts = known.groupBy(F.window(ts, length, slide).alias("w"), F.col(kind).cast("string").alias("kind")).agg(F.count("*").alias("n"))
        counts = counts.select("w.start", "w.end", "kind", "n", F.when(behind, F.col("n")).otherwise(0).alias("late")).persist()
        try:
            newest = known.agg(F.max(ts).cast("string")).first()[0]
            newest = max(x for x in (newest, seen) if x) if newest or seen else None
            table.apply(counts, batch_id, merged, checkpoint, {"latest": newest})
        finally:
            counts.unpersist()

    return _start(source, apply, checkpoint, trigger)


def stream_daily(source: DataFrame, ts: str, kind: str, watermark: str, target: str, checkpoint: str, **trigger) -> StreamingQuery:
    """New rows per day and kind."""
    return stream_trailing(source, ts, kind, watermark, target, checkpoint, "1 day", "1 day", **trigger)


def window_counts(spark: SparkSession, target: str) -> DataFrame:
    """start, end, kind, n, late as of the last batch."""
    return VersionedTable(spark, target).read()


def running_totals(counts: DataFrame) -> DataFrame:
    """Add `total`, the cumulative count per kind; one row per day, so the window stays small."""
    from pyspark.sql import Window as W

    upto = W.partitionBy("kind").orderBy("start").rowsBetween(W.unboundedPreceding, 0)
    return counts.withColumn("total", F.sum("n").over(upto))
