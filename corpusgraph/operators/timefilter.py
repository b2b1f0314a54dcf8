"""Time presets, bounds and time-lapse frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PRESETS = {"1D": "INTERVAL 1 DAY", "1W": "INTERVAL 7 DAYS", "1M": "INTERVAL 1 MONTH", "1Y": "INTERVAL 1 YEAR"}


def time_filter(df: DataFrame, col: str, preset: str, as_of: str) -> DataFrame:
    """Rows from `as_of` back over the preset, both ends included; ALL keeps every row."""
    if preset == "ALL":
        return df
    end = F.lit(as_of).cast("timestamp")
    return df.filter(F.col(col).between(end - F.expr(PRESETS[preset]), end))


def time_range(df: DataFrame, col: str, low: str, high: str) -> DataFrame:
    return df.filter(F.col(col).between(F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")))


def preset_counts(df: DataFrame, col: str, as_of: str) -> DataFrame:
    """preset, n for every preset in one pass."""
    end = F.lit(as_of).cast("timestamp")
    hits = [F.count_if(F.col(col).between(end - F.expr(i), end)).alias(p) for p, i in PRESETS.items()]
    row = df.agg(*hits, F.count("*").alias("ALL"))
    return row.select(F.inline(F.array(*[F.struct(F.lit(p).alias("preset"), F.col(p).alias("n")) for p in [*PRESETS, "ALL"]])))


def time_bounds(df: DataFrame, col: str = "created_at") -> DataFrame:
    return df.agg(F.min(col).alias("min_ts"), F.max(col).alias("max_ts"))


def timelapse(nodes: DataFrame, col: str = "created_at", days_per_frame: int = 1) -> DataFrame:
    """frame, frame_end, n_new, n_total as the upper bound advances; the last frame ends at the newest row.

    Rows are counted per frame first; the running total then sees one row per
    frame, a number bounded by the calendar.
    """
    step = days_per_frame * 86_400_000_000
    at = F.unix_micros(F.col(col).cast("timestamp"))
    low, high = nodes.agg(F.min(at)).scalar(), nodes.agg(F.max(at)).scalar()
    counts = (
        nodes.filter(F.col(col).isNotNull())
        .groupBy(F.ceil((at - low) / F.lit(step)).alias("frame"))
        .agg(F.count("*").alias("n_new"))
    )
    last = F.ceil((high - low) / F.lit(step))
    frames = nodes.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("frame"))
    running = W.orderBy("frame").rowsBetween(W.unboundedPreceding, 0)
    out = frames.join(counts, "frame", "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)).cast("long"))
    end = F.timestamp_micros(F.least(low + F.col("frame") * step, high))
    return out.select("frame", end.alias("frame_end"), "n_new", F.sum("n_new").over(running).alias("n_total"))
