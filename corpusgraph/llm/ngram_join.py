"""Exact n-gram Jaccard join with set-relation skipping.

A text's set is its distinct word n-grams (64-bit hashes; texts with fewer
words are one n-gram). Texts with equal sets form a class at once, and only
classes are compared. The join follows the prefix principle under one global
order of n-grams, rare ones first, and skips in two ways:

- Index skipping. The list of an n-gram holds its classes sorted by set size;
  it is read in blocks, each begun by a leader, whose members are all large
  enough to match the leader. Other blocks are skipped by size and position.
- Answer skipping. First every member is compared with its leader only. Where
  both turn out linked to one component nothing more is asked. Those apart try
  a few more leaders. For who is left, the leader's computed distances bound a
  pair's distance (Jaccard distance is a metric), and only pairs that the bound
  leaves open are compared.

So a group of near copies costs about one comparison per copy, and still every
link between components is found. The order comes from a sketch of fixed size,
counted over all texts; it decides speed, never results. Sets travel as packed
arrays per bucket of n-grams, pairs as ids; texts are joined to pairs only for
the classes that occur in one.

Defined results: null, empty and blank texts have an empty set and are their
own component; repeated rows and ids each get a row; texts without an id link
as others do, and their component is null if no text in it has an id; no
documents, no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.functions.scale import checkpoint_root, cut_light as cut, discard
from corpusgraph.llm.common import (
    BINARY, LONG, LOWER, NOT_BLANK, U64, Words, annotate, bounded_batches, buffers, grams, mix, quoted, record, release, sequence_hash, slices, words,
)
from corpusgraph.operators.graph import component_labels

#: Counters of the sketch, and rows they are sent in.
SKETCH = 1 << 22
_CHUNK = 1 << 16
#: N-grams of one bucket, about.
BUCKET_ENTRIES = 400_000
#: Bytes of text whose prefixes are packed together.
PACK_BYTES = 64 << 20

_MARK = U64(0xD1B54A32D192ED03)


def sets(data: np.ndarray, at: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of the text and its sorted distinct n-gram hashes; texts without words are left out."""
    found = words(data, at, NOT_BLANK, LOWER)
    value, where = grams(found, n)
    first = np.searchsorted(where, found.first)
    for i in np.flatnonzero(np.diff(found.first)):
        own = value[first[i] : first[i + 1]]
        yield int(i), np.unique(own) if len(own) else _short(found, i)


def _short(found: Words, i: int) -> np.ndarray:
    return np.array([sequence_hash(found.hash[found.first[i] : found.first[i + 1]])], U64)


def digest(own: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set, as signed numbers."""
    one = mix(own).sum(dtype=U64) + U64(len(own))
    two = mix(own ^ _MARK).sum(dtype=U64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def least_overlap(a, b, percent: int):
    """Smallest common size of sets of sizes a and b whose Jaccard similarity reaches the threshold."""
    return -(-(percent * (a + b)) // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    return size - -(-(percent * size) // 100) + 1


#: Longs of the parity bitmap of a set.
BITMAP = 16
#: Smallest lists of a class that go along with it, to tell in which list a pair was met before.
FIRST_LISTS = 6


def parities(own: np.ndarray) -> list[int]:
    """For each of 64 * BITMAP cells, whether an odd number of n-grams falls into it.

    Two bitmaps differ in at most as many cells as the sets in n-grams, so they bound a similarity from above.
    """
    cells = np.bincount((own % U64(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64).tolist()


_SCAN = record(doc_id=LONG, n=LONG, one=LONG, two=LONG, bits=T.ArrayType(LONG), chunk=LONG, counts=BINARY)
_LONGS = pa.list_(pa.int64())


def _scan(docs: DataFrame, n: int) -> DataFrame:
    """A row per text with size and digest of its set, and rows of sketch counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(SKETCH, np.uint32)
        met: set[int] = set()
        for batch in batches:
            for part in slices(batch, 1):
                rows = [(i, 0, None, None, None) for i in part.column(0).to_pylist()]
                held = []
                for i, own in sets(*buffers(part.column(1)), n):
                    one, two = digest(own)
                    rows[i] = (rows[i][0], len(own), one, two, parities(own))
                    if one not in met:
                        met.add(one)
                        held.append(own)
                if held:
                    counters += np.bincount((np.concatenate(held) >> U64(42)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
                ids, sizes, ones, twos, bits = zip(*rows, strict=True)
                none = pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in (ids, sizes, ones, twos)], pa.array(bits, _LONGS), none, pa.nulls(len(rows), pa.binary())],
                    names=_SCAN.names,
                )
        if met:
            for k in range(SKETCH // _CHUNK):
                own = np.minimum(counters[k * _CHUNK : (k + 1) * _CHUNK], 65535).astype(np.uint16)
                if own.any():
                    columns = [pa.nulls(1, pa.int64())] * 4 + [pa.nulls(1, _LONGS), pa.array([k], pa.int64()), pa.array([own.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=_SCAN.names)

    return docs.mapInArrow(run, _SCAN)


def _sketch(scanned: DataFrame) -> np.ndarray:
    """Counters summed over all tasks and rounded to powers of two: one byte each, however large the corpus."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CHUNK, np.uint64)
        for batch in batches:
            for counts in batch.column(1):
                total += np.frombuffer(counts.as_buffer(), np.uint16)
        level = np.ceil(np.log2(total + 1.0)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([level.tobytes()], pa.binary())], names=["chunk", "counts"])

    out = np.zeros(SKETCH, np.uint8)
    parts = scanned.filter("chunk IS NOT NULL").select("chunk", "counts")
    # At most SKETCH / _CHUNK rows come back.
    for row in parts.groupBy("chunk").applyInArrow(add, record(chunk=LONG, counts=BINARY)).collect():
        out[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] = np.frombuffer(row["counts"], np.uint8)
    return out


_PACKED = record(bucket=LONG, grams=BINARY, keys=BINARY, sizes=BINARY, places=BINARY)
_ENTRY = record(gram=LONG, leader=LONG, key=LONG, size=LONG, place=LONG, members=LONG)


def _prefixes(docs: DataFrame, n: int, percent: int, level: np.ndarray, n_buckets: int) -> DataFrame:
    """Packed prefix entries (n-gram, class, set size, place in the set) per bucket of n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        met: set[int] = set()
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            gram, key, count, place = (np.concatenate(c) for c in zip(*held, strict=True))
            bucket = (gram % U64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            columns = [c[order] for c in (gram, key, count, place)]
            for lo in range(0, n_buckets, 64):
                rows = [b for b in range(lo, min(lo + 64, n_buckets)) if edges[b] < edges[b + 1]]
                if rows:
                    data = [pa.array([c[edges[b] : edges[b + 1]].tobytes() for b in rows], pa.binary()) for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *data], names=_PACKED.names)

        for batch in batches:
            for part in slices(batch, 0):
                data, at = buffers(part.column(0))
                for _, own in sets(data, at, n):
                    one, _ = digest(own)
                    if one in met:
                        continue
                    met.add(one)
                    count = prefix_length(len(own), percent)
                    order = np.lexsort((own, rank[(own >> U64(42)).astype(np.int64)]))[:count]
                    gram = own[order]
                    held.append((gram, np.full(count, one, np.int64), np.full(count, len(own), np.int32), np.arange(count, dtype=np.int32)))
                size += len(data)
                if size > PACK_BYTES and held:
                    yield from packed()
                    held, size = [], 0
        if held:
            yield from packed()

    return docs.select("text").mapInArrow(run, _PACKED)


def _lists(packed: DataFrame, percent: int) -> DataFrame:
    """Entries of every list with two classes or more, each with the leader of its block.

    Lists with equal members, as in groups of near copies, are kept once per bucket.
    """

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (np.uint64, np.int64, np.int32, np.int32)
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            for i, kind in enumerate(kinds):
                parts[i] += [np.frombuffer(x.as_buffer(), kind) for x in batch.column(i + 1)]
        gram, own, size, place = (np.concatenate(p) for p in parts)
        order = np.argsort(gram, kind="stable")
        gram = gram[order]
        twice = np.zeros(len(gram), bool)
        same = gram[1:] == gram[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        order, gram = order[twice], gram[twice]
        own, size, place = own[order], size[order], place[order]
        order = np.lexsort((own, size, gram))
        gram, own, size, place = gram[order], own[order], size[order], place[order]
        if len(gram):
            fresh = np.ones(len(gram), bool)
            fresh[1:] = (gram[1:] != gram[:-1]) | (own[1:] != own[:-1])
            gram, own, size, place = gram[fresh], own[fresh], size[fresh], place[fresh]
            begin = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            count = np.diff(np.append(begin, len(gram)))
            mark = np.add.reduceat(mix(own.astype(U64)), begin)
            _, keep = np.unique(np.stack((mark, count.astype(U64))), axis=1, return_index=True)
            keep = np.sort(keep[count[keep] > 1])
            for lo in range(0, len(keep), 256):
                rows = []
                for k in keep[lo : lo + 256]:
                    a, b = begin[k], begin[k] + count[k]
                    leader = np.empty(b - a, np.int64)
                    at = a
                    while at < b:
                        stop = int(np.searchsorted(size[at:b].astype(np.int64) * percent, 100 * int(size[at]), side="right")) + at
                        leader[at - a : stop - a] = own[at]
                        at = stop
                    rows.append((gram[a:b].astype(np.int64), leader, own[a:b], size[a:b], place[a:b], np.full(b - a, b - a)))
                columns = [np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_ENTRY.names)

    return packed.groupBy("bucket").applyInArrow(run, _ENTRY)


_CHECKED = record(a=LONG, b=LONG, common=LONG, total=LONG)


def digests(docs: DataFrame, n: int = 5) -> DataFrame:
    """The rows with `one` and `two`, the digest of each text's set (null for an empty set)."""
    kind = record(one=LONG, two=LONG)

    def work(texts: pa.Array) -> pa.Array:
        out = [(None, None)] * len(texts)
        for i, own in sets(*buffers(texts), n):
            out[i] = digest(own)
        one, two = zip(*out, strict=True)
        return pa.StructArray.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=kind.names)

    into = "_digest"
    while into in docs.columns:
        into += "_"
    found = annotate(docs, "text", lambda: work, kind, into)
    return found.select(*quoted(docs.columns), f"{into}.one", f"{into}.two")


def _texts(listed: DataFrame, classes: DataFrame, docs: DataFrame, n: int, name: str) -> DataFrame:
    """at, text of every class in `listed(one)`, written in buckets by `at` so that no comparison shuffles it again.

    A class is found by its smallest id, and one without any id by its digest. An id may stand for other texts too, which
    `_compare` tells by their digests. The folder is one of `scale.cut`'s; the table `name` is known to this session only.
    """
    spark = docs.sparkSession
    own = classes.select("one", "doc_id").join(listed, "one", "left_semi")
    named = own.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("at")).distinct()
    body = docs.select(F.col("doc_id").alias("at"), "text").join(named, "at", "left_semi")
    unnamed = own.filter("doc_id IS NULL").select(F.col("one").alias("at"))
    if unnamed.head(1):
        found = digests(docs.filter("doc_id IS NULL").select("text"), n).select(F.col("one").alias("at"), "text")
        body = body.unionByName(found.join(unnamed, "at", "left_semi").dropDuplicates(["at"]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{checkpoint_root(spark)}/corpusgraph-{uuid.uuid4().hex}"
    # The join has dealt the rows out by `at` already.
    body.write.bucketBy(parts, "at").sortBy("at").option("path", path).saveAsTable(name)
    return spark.table(name)


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b, at_a, at_b (where their texts are), n_a, n_b of the pairs (a, b) whose sizes and bitmaps leave a similarity of `percent` open."""
    ends = []
    for end in ("a", "b"):
        cells = [F.col("bits")[i].alias(f"{end}_bits{i}") for i in range(BITMAP)]
        ends.append(classes.select(F.col("one").alias(end), F.col("n").alias(f"n_{end}"), _at().alias(f"at_{end}"), *cells))
    rows = pairs.join(ends[0], "a").join(ends[1], "b")
    differ = sum((F.bit_count(F.col(f"a_bits{i}").bitwiseXOR(F.col(f"b_bits{i}"))) for i in range(1, BITMAP)), F.bit_count(F.col("a_bits0").bitwiseXOR(F.col("b_bits0"))))
    both = F.col("n_a") + F.col("n_b")
    need = F.ceil(both * percent / (100 + percent))
    sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    # A digest may stand for two sets by chance; such a pair is met once.
    return rows.filter(sized & (differ <= both - 2 * need)).select(*_PAIR).distinct()


_PAIR = ("a", "b", "at_a", "at_b", "n_a", "n_b")


def _at() -> Column:
    return F.coalesce("doc_id", "one")


def _placed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) with where their texts are, and the sizes of their sets."""
    for end in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("one").alias(end), _at().alias(f"at_{end}"), F.col("n").alias(f"n_{end}")), end)
    return pairs.select(*_PAIR).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    own = pairs
    for end in ("a", "b"):
        own = own.join(labels.select(F.col("id").alias(end), F.col("component").alias(f"in_{end}")), end, "left")
    return own.filter(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select(*pairs.columns)


def _compare(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """a, b, common, total (size of the union) of class pairs, from the texts of one document of each class.

    The texts lie in buckets: only one of a pair travels, that of the smaller set y, to the bucket of the other, x.
    """
    stays = F.col("n_a") >= F.col("n_b")
    ends = [F.when(stays, F.col(f"{p}{k}")).otherwise(F.col(f"{p}{o}")).alias(f"{p}{e}") for e, k, o in (("x", "a", "b"), ("y", "b", "a")) for p in ("", "at_")]
    left = texts.select(F.col("at").alias("at_x"), F.col("text").alias("text_x"))
    right = texts.select(F.col("at").alias("at_y"), F.col("text").alias("text_y"))
    both = pairs.select("a", "b", *ends).join(right, "at_y").join(left, "at_x").select("a", "b", "x", "y", "text_x", "text_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, U64))
        for batch in batches:
            for part in slices(batch, 5):
                a, b, x, y = (part.column(i).to_pylist() for i in range(4))
                out = []
                for i, mine in sets(*buffers(part.column(5)), n):
                    if x[i] != last[0]:
                        one = [s for _, s in sets(*buffers(part.column(4).slice(i, 1)), n)]
                        # A document id may stand for several texts; only the class's own text counts.
                        last = (x[i], one[0]) if one and digest(one[0])[0] == x[i] else (None, np.zeros(0, U64))
                    if len(last[1]) and digest(mine)[0] == y[i]:
                        common = len(np.intersect1d(last[1], mine, assume_unique=True))
                        out.append((a[i], b[i], common, len(last[1]) + len(mine) - common))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=_CHECKED.names)

    return cut(both.mapInArrow(run, _CHECKED))


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Labels (id, component) after more links; None or the same ones if these join nothing new.

    Only links between two components known so far are followed, each component as one node.
    """
    ends = links.select(F.col("a").alias("source"), F.col("b").alias("target"))
    if labels is None:
        return cut(component_labels(ends))
    for end in ("source", "target"):
        own = labels.select(F.col("id").alias(end), F.col("component").alias("part"))
        ends = ends.join(own, end, "left").withColumn(end, F.coalesce("part", end)).drop("part")
    ends = cut(ends.filter("source <> target").distinct())
    if not ends.head(1):
        discard(ends)
        return labels
    joined = cut(component_labels(ends))
    final = joined.select(F.col("id").alias("component"), F.col("component").alias("final"))
    moved = labels.join(final, "component", "left").select("id", F.coalesce("final", "component").alias("component"))
    out = cut(moved.unionByName(joined.join(labels, "id", "left_anti")))
    discard(ends)
    discard(joined)
    return out


def _parts(held: DataFrame, labels: DataFrame) -> DataFrame:
    """List entries with their component, in lists where not all are in one; `top` is the component of most."""
    rows = held.join(labels.withColumnRenamed("id", "key"), "key", "left")
    rows = cut(rows.select(*held.columns, F.coalesce("component", "key").alias("part")))
    sizes = rows.groupBy("gram", "part").agg(F.count("*").alias("n"))
    tops = sizes.groupBy("gram").agg(F.max_by("part", F.struct("n", "part")).alias("top"), F.count("*").alias("parts"))
    out = cut(rows.join(tops.filter("parts > 1").drop("parts"), "gram"))
    discard(rows)
    return out


def _tries(parts: DataFrame, turn: int) -> DataFrame:
    """Pairs of members apart with a member drawn from most of the list, and with one drawn from those apart.

    The draw is by a hash of the class, so lists that share members agree on it.
    """
    draw = F.xxhash64("key", F.lit(turn))
    apart = F.col("part") != F.col("top")
    drawn = parts.groupBy("gram").agg(
        F.min_by("key", F.when(~apart, draw)).alias("most"), F.min_by("key", F.when(apart, draw)).alias("other")
    )
    rows = parts.filter(apart).select("gram", F.col("key").alias("b")).join(drawn, "gram")
    pairs = rows.select(F.explode(F.array("most", "other")).alias("a"), "b")
    return pairs.filter("a <> b").distinct()


def _open_pairs(parts: DataFrame, known: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components that sizes, places, bitmaps and the leader's distances leave open.

    A pair shares many lists, and every bound holds in each of them, so one list decides: the smallest that both
    classes' few smallest lists have in common. Where those have none in common, the pair is formed in every list.
    """
    # Members that are too large or small for all of their list's that are apart from most go before anything is joined.
    ranges = parts.filter("part <> top").groupBy("gram").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    near = (F.col("size") * 100 >= F.col("low") * percent) & (F.col("high") * 100 >= F.col("size") * percent)
    parts = cut(parts.join(ranges, "gram").filter(near).select(*parts.columns))
    far = known.select(F.col("a").alias("leader"), F.col("b").alias("key"), (1 - F.col("common") / F.col("total")).alias("away"))
    rows = parts.join(far.groupBy("leader", "key").agg(F.min("away").alias("away")), ["leader", "key"], "left")
    rows = rows.withColumn("away", F.when(F.col("leader") == F.col("key"), 0.0).otherwise(F.col("away")))
    cells = classes.select(F.col("one").alias("key"), "bits")
    cells = cells.join(parts.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    # A class has at most as many lists as its own prefix has n-grams.
    own = parts.groupBy("key").agg(F.slice(F.array_sort(F.collect_set("gram")), 1, FIRST_LISTS).alias("lists"))
    # These rows are wide and many: size and place share one number.
    spot = F.shiftleft("size", 32).bitwiseOR(F.col("place")).alias("spot")
    narrow = [c for c in rows.columns if c not in ("size", "place")]
    rows = cut(rows.join(cells.join(own, "key"), "key").select(*narrow, spot, "lists", *[F.col("bits")[i].alias(f"bits{i}") for i in range(BITMAP)]))
    other = rows.select("gram", *[F.col(c).alias(f"o_{c}") for c in rows.columns if c not in ("gram", "top")])
    differ = sum((F.bit_count(F.col(f"bits{i}").bitwiseXOR(F.col(f"o_bits{i}"))) for i in range(1, BITMAP)), F.bit_count(F.col("bits0").bitwiseXOR(F.col("o_bits0"))))
    size, o_size = F.shiftright("spot", 32), F.shiftright("o_spot", 32)
    place, o_place = F.col("spot").bitwiseAND(0xFFFFFFFF), F.col("o_spot").bitwiseAND(0xFFFFFFFF)
    small, large = F.least(size, o_size), F.greatest(size, o_size)
    need = F.ceil((size + o_size) * percent / (100 + percent))
    # Common n-grams before this one are at most the smaller place, those from here on at most the shorter rest.
    reach = F.least(place, o_place) + F.least(size - place, o_size - o_place)
    apart_by_leader = (F.col("leader") == F.col("o_leader")) & (F.abs(F.col("away") - F.col("o_away")) > (100 - percent) / 100 + 1e-9)
    pairs = rows.filter("part <> top").join(other, "gram").filter(
        (F.col("part") != F.col("o_part"))
        # Both orders meet only where neither is of the top component.
        & ((F.col("o_part") == F.col("top")) | (F.col("key") < F.col("o_key")))
        & (small * 100 >= large * percent)
        & (reach >= need)
        & (differ <= size + o_size - 2 * need)
        & ~F.coalesce(apart_by_leader, F.lit(False))
        & (F.col("gram") <= F.coalesce(F.array_min(F.array_intersect("lists", "o_lists")), F.col("gram")))
    )
    asked = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.select(F.least("key", "o_key").alias("a"), F.greatest("key", "o_key").alias("b")).distinct().join(asked, ["a", "b"], "left_anti")


def jaccard_components(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, rounds: int = 1,
    digested: bool = False,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), one row per document; if `digested` also one and two.

    Two documents link when 100 * common n-grams >= percent * n-grams of either.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    scanned = cut(_scan(docs, n))
    level = _sketch(scanned)
    rows = scanned.filter("chunk IS NULL").select("doc_id", "n", "one", "two")
    sized = scanned.filter("chunk IS NULL AND n > 0").groupBy("one", "two")
    classes = cut(sized.agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits")))
    total = classes.agg(F.sum("n")).first()[0] or 0
    n_buckets = 1 + int(total * (100 - percent) / 100) // BUCKET_ENTRIES

    lists = cut(_lists(_prefixes(docs, n, percent, level, n_buckets), percent))
    release(docs.sparkSession)
    name = f"corpusgraph_{uuid.uuid4().hex}"
    texts = _texts(lists.select(F.col("key").alias("one")).distinct(), classes, docs, n, name)
    stars = lists.filter("leader <> key").select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    stars = cut(_bounded(stars, classes, percent))
    release(docs.sparkSession)
    linked = F.col("common") * 100 >= F.col("total") * percent
    # One leader of each member first; the others only where that did not bring the two together.
    first = stars.groupBy("b").agg(F.min_by(F.struct(*_PAIR), "a").alias("x")).select(*[f"x.{c}" for c in _PAIR])
    met = _compare(first, texts, n)
    labels = _merged(None, met.filter(linked))
    others = _compare(_apart(stars, labels).join(met, ["a", "b"], "left_anti"), texts, n)
    known = cut(met.unionByName(others))
    merged = _merged(labels, others.filter(linked))
    for used in (stars, met, others, *([] if merged is labels else [labels])):
        discard(used)
    labels = merged
    release(docs.sparkSession)

    # Members not connected with most of their list try leaders drawn anew, so that groups of near copies
    # whose distances straddle the threshold close up before any pair of members is formed.
    held = cut(lists.filter("members > 2").drop("members"))
    discard(lists)
    parts = _parts(held, labels)
    for turn in range(rounds):
        met = known.select("a", "b").union(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
        asked = cut(_bounded(_tries(parts, turn).join(met, ["a", "b"], "left_anti"), classes, percent))
        if not asked.head(1):
            discard(asked)
            break
        tried = _compare(asked, texts, n)
        both = cut(known.unionByName(tried))
        merged = _merged(labels, tried.filter(linked))
        for used in (asked, tried, known):
            discard(used)
        known = both
        if merged is not labels:
            discard(parts)
            discard(labels)
            labels = merged
            parts = _parts(held, labels)
    rest = cut(_open_pairs(parts, known, classes, percent))
    final = labels
    if rest.head(1):
        last = _compare(_placed(rest, classes), texts, n)
        final = _merged(labels, last.filter(linked))
        discard(last)
    for used in (held, parts, rest, known, texts):
        discard(used)
    docs.sparkSession.sql(f"DROP TABLE {name}")
    named = classes.join(final.withColumnRenamed("id", "one"), "one", "left").withColumn("part", F.coalesce("component", "one"))
    smallest = named.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    by_class = named.join(smallest, "part").select("one", "two", "component_id")
    out = rows.join(by_class, ["one", "two"], "left")
    out = cut(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), *(["one", "two"] if digested else [])))
    for used in (scanned, classes, final, labels):
        discard(used)
    return out
