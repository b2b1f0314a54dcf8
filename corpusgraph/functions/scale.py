"""Helpers that keep results whole when one key holds a large share of the rows.

`ranked`, `with_neighbours` and `paged` replace window functions and
collect_list over groups of unknown size: rows are range-partitioned by
(group, order), so a hot group is spread over many tasks, and the pieces are
stitched with one summary row per (partition, group).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusgraph.functions.text import BLANK_CHARS


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for cut lineage, as named by the cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def cut(df: DataFrame, *folders: str, codec: str = "zstd") -> DataFrame:
    """Write `df` to the shared checkpoint folder and read it back.

    The table survives lost executors, ends the lineage, fixes every
    nondeterministic value and gives the optimizer a true size. Rows lie in
    one folder per value of the columns `folders`.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/corpusgraph-{uuid.uuid4().hex}"
    df.write.option("compression", codec).partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_light(df: DataFrame, *folders: str) -> DataFrame:
    """`cut` with Spark's light codec, for operators measured with it under a memory limit."""
    return cut(df, *folders, codec="snappy")


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by `cut` once nothing reads it."""
    spark = df.sparkSession
    marker = "/corpusgraph-"
    folders = {head + marker + rest.split("/")[0] for head, _, rest in (f.rpartition(marker) for f in df.inputFiles() if marker in f)}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the input has fewer splits than that.

    For text work on a few large files. Inputs with enough splits, which is
    every large one, are returned as they are and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A plain projection may be repeated by the optimizer in every filter and
    expression that uses it; a generator of one row is not.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _stitch(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the small summary on `keys`, nulls matching nulls."""
    renamed = summary.withColumnsRenamed({k: f"_s_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_s_{key}"))
    return rows.join(renamed, condition)


def _placed(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranges = df.repartitionByRange(*[F.col(g) for g in group], *order)
    return cut(ranges.withColumn("_part", F.spark_partition_id()))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank", distinct: bool = False) -> DataFrame:
    """Exact row_number per group (`order` must be unique inside a group; with `distinct`, of different rows).

    Rows are numbered where they are sorted, so they are shuffled once; the summary is written, so that Spark knows
    its size and, where it is small, joins it without moving the rows again.
    """
    group = list(group)
    keys = [F.col(g) for g in group]
    ranges = df.repartitionByRange(*keys, *order)
    # Equal rows lie in one range: they are dropped there, without a shuffle of their own.
    ranges = (ranges.distinct() if distinct else ranges).sortWithinPartitions(*keys, *order)
    # Numbers rise by one from row to row of a part.
    placed = cut(ranges.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()))
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = (
        placed.groupBy("_part", *group)
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)
        .drop("_n", "_first")
    )
    joined = _stitch(placed, cut(sizes), ["_part", *group])
    return joined.select(*df.columns, (F.col("_id") + F.col("_offset")).cast("long").alias(name))


def with_neighbours(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, prev: str, next_: str
) -> DataFrame:
    """Add the previous and next `value` inside the group, wrapping at both ends."""
    group = list(group)
    placed = _placed(df, group, order)
    here = W.partitionBy("_part", *group).orderBy(*order)
    local = placed.withColumn("_lag", F.lag(value).over(here)).withColumn("_lead", F.lead(value).over(here))
    keys = ["_part", *group]
    firsts = local.filter("_lag IS NULL").select(*keys, F.col(value).alias("_first"))
    lasts = local.filter("_lead IS NULL").select(*keys, F.col(value).alias("_last"))
    # One row per (partition, group): as small as the number of partitions.
    edges = _stitch(firsts, lasts, keys).select(*keys, "_first", "_last")
    parts = W.partitionBy(*group).orderBy("_part")
    whole = parts.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    edges = edges.select(
        *keys,
        F.coalesce(F.lag("_last").over(parts), F.last("_last").over(whole)).alias("_before"),
        F.coalesce(F.lead("_first").over(parts), F.first("_first").over(whole)).alias("_after"),
    )
    return _stitch(local, edges, keys).select(
        *df.columns,
        F.coalesce("_lag", "_before").alias(prev),
        F.coalesce("_lead", "_after").alias(next_),
    )


def paged(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str | Column, page_size: int, name: str, distinct: bool = False
) -> DataFrame:
    """Ordered lists cut into pages of `page_size`, so no list grows with the data; with `distinct`, of different rows."""
    group = list(group)
    # A value that is a column is not carried twice.
    own, df = (value, df) if isinstance(value, str) else ("_value", df.withColumn("_value", value))
    numbered = ranked(df, group, order, "_rank", distinct).withColumn("_value", F.col(own))
    return (
        numbered.withColumn("page", F.floor((F.col("_rank") - 1) / page_size).cast("long"))
        .groupBy(*group, "page")
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "_value"))).alias("_items"))
        .select(*group, "page", F.col("_items._value").alias(name))
    )


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """First `k` rows per group (`order` must be unique inside a group).

    Spark drops surplus rows before the shuffle while `k` is within its own limit for that.
    Beyond it the rows are ranked by `ranked`, so a hot group still never meets in one task.
    """
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return ranked(df, by, order, name).filter(F.col(name) <= k)
    numbered = df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return numbered.filter(F.col(name) <= k).withColumn(name, F.col(name).cast("long"))


#: Lengths of the pieces of words by which patterns are found, the first that a word of the pattern has.
_PIECES = (6, 3, 1)

#: So many patterns are sent to every task at most, a few dozen MB.
_FEW = 200_000

#: So many patterns are each tried on every text, which costs less than the pieces of one text.
_TRIED = 64


def _pieces(text: Column, n: int) -> Column:
    """Distinct pieces of `n` letters of the words of a text."""
    words = F.array_distinct(F.split(F.translate(text, BLANK_CHARS, " " * len(BLANK_CHARS)), " "))
    long_enough = F.filter(words, lambda w: F.length(w) >= n)
    return F.array_distinct(F.flatten(F.transform(
        long_enough, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - (n - 1)), lambda i: F.substring(w, i, F.lit(n)))
    )))


def _words(text: Column) -> Column:
    """Distinct words of a text, cut at blanks of any kind."""
    plain = F.when(text.rlike("[^ -~]"), F.translate(text, BLANK_CHARS, " " * len(BLANK_CHARS))).otherwise(text)
    return F.filter(F.array_distinct(F.split(plain, " ")), lambda w: w != "")


def _holding(words: DataFrame, word: str, parts: DataFrame, part: str) -> DataFrame:
    """The columns of both where a word contains a part, as an equi-join on the piece of the part that the fewest words hold."""
    n_letters = F.length(part)
    size = F.coalesce(*[F.when(n_letters >= n, F.lit(n)) for n in _PIECES])
    own = F.coalesce(*[F.when(size == n, _pieces(F.col(part), n)) for n in _PIECES])
    asked = cut(parts.select(part, size.alias("_size"), F.explode(own).alias("_piece")))
    sizes = sorted(r["_size"] for r in asked.select("_size").distinct().collect())  # at most three numbers

    def pieces(n: int) -> DataFrame:
        rows = words.select(word, F.explode(_pieces(F.col(word), n)).alias("_piece"))
        return rows.join(asked.filter(F.col("_size") == n).select("_piece").distinct(), "_piece", "left_semi")

    if not sizes:
        return words.limit(0).crossJoin(parts.limit(0))
    held = pieces(sizes[0])
    for n in sizes[1:]:
        held = held.unionByName(pieces(n))
    held = cut(held)
    counted = asked.join(held.groupBy("_piece").count(), "_piece")
    rarest = counted.groupBy(part).agg(F.min_by("_piece", F.struct("count", "_piece")).alias("_piece"), F.count("*").alias("_found"))
    # A part of which a piece is in no word is in none.
    whole = asked.groupBy(part).agg(F.count("*").alias("_wanted"))
    rarest = rarest.join(whole, part).filter("_found = _wanted").select(part, "_piece")
    pairs = held.join(rarest, "_piece").filter(F.contains(F.col(word), F.col(part))).select(word, part)
    return pairs.join(words, word)


def contains_join(left: DataFrame, text: str, patterns: DataFrame, pattern: str, on: Sequence[str] = (), written: bool = False) -> DataFrame:
    """Join rows whose `text` contains `pattern`, and that agree in the columns `on`, as an equi-join on rare words.

    A pattern's every word is inside some word of the text. The texts' words are counted, and each pattern's words looked
    for in them once, not in every text; a pattern comes to the texts with the one of its longer words that the fewest
    texts hold. Up to `_FEW` patterns come to the texts, which stay where they are; of more, only the texts' numbers
    move with their words, and texts come in where a pattern's rarest word was found. Exact for any pattern; an empty
    one is in no text. Up to `_TRIED` patterns are tried on every text as they are, whatever their words.

    `left` is read several times, unless they are so few: it is written first, unless the caller says that it is `written` already.
    """
    wanted = cut(patterns.filter(F.length(pattern) > 0).withColumn("_no", F.monotonically_increasing_id()))
    others = [c for c in patterns.columns if c not in on]
    n_wanted = wanted.limit(_FEW + 1).count()

    def tried(asked_of: DataFrame) -> DataFrame:
        asked_of = asked_of.drop("_no").withColumnsRenamed({c: f"_on_{c}" for c in on})
        holds = F.contains(F.col(text), F.col(pattern))
        for c in on:
            holds = holds & (F.col(c) == F.col(f"_on_{c}"))
        return left.join(asked_of, holds).select(*left.columns, *others)

    if n_wanted <= _TRIED:
        return tried(wanted)
    few = n_wanted <= _FEW
    left = left if written and few else cut(left if few else left.withColumn("_row", F.monotonically_increasing_id()))
    said = cut(left.select(F.explode(_words(F.col(text))).alias("_word")).groupBy("_word").agg(F.count("*").alias("_texts")))
    # Of a pattern's words the longer ones are asked for: what is short is in many words.
    longest = F.array_max(F.transform(_words(F.col(pattern)), F.length))
    least = F.coalesce(*[F.when(longest >= n, F.lit(n)) for n in _PIECES])
    parts = cut(wanted.select("_no", F.explode(F.filter(_words(F.col(pattern)), lambda w: F.length(w) >= least)).alias("_part")))
    pairs = cut(_holding(said, "_word", parts.select("_part").distinct(), "_part"))
    held = parts.join(pairs.groupBy("_part").agg(F.sum("_texts").alias("_n")), "_part", "left")
    # A pattern of which a word is in no text needs no asking.
    rarest = held.groupBy("_no").agg(F.min_by("_part", F.struct(F.coalesce("_n", F.lit(0)), "_part")).alias("_part"))
    known = cut(rarest.join(pairs.select("_part", "_word"), "_part"))
    if few:
        # A text that holds the part in several words counts once, by the first of them.
        first = F.get(F.filter(_words(F.col(text)), lambda w: F.contains(w, F.col("_part"))), F.lit(0))
        asked_of = cut(known.join(wanted, "_no").drop("_no").withColumnsRenamed({c: f"_on_{c}" for c in on}))
        found = left.withColumn("_word", F.explode(_words(F.col(text)))).join(asked_of, "_word")
        for c in on:
            found = found.filter(F.col(c) == F.col(f"_on_{c}"))
        found = found.filter(F.contains(F.col(text), F.col(pattern))).filter(F.col("_word") == first).select(*left.columns, *others)
    else:
        places = left.select("_row", F.explode(_words(F.col(text))).alias("_word"))
        hits = places.join(known.select("_word", "_no"), "_word").select("_row", "_no").distinct().join(wanted, "_no")
        found = hits.join(left, ["_row", *on]).filter(F.contains(F.col(text), F.col(pattern)))
        found = found.select(*[c for c in left.columns if c != "_row"], *others)
    # Of a pattern of blanks only, nothing is known: all rows are asked.
    blank = wanted.filter(longest.isNull())
    if not blank.head(1):
        return found
    left = left.drop("_row")
    return found.unionByName(tried(blank))
