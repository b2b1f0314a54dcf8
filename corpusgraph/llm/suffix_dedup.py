"""Removal of repeated byte strings: everything covered by a string of `length` bytes that also starts earlier.

Texts are UTF-8 bytes; strings never cross texts; earlier means a smaller
document id, or the same document and a smaller offset.

1. Every window of `length` bytes chooses an anchor, the least hash among its
   k-grams, leftmost on ties. Equal windows choose equal anchors, so windows
   with different anchors never need to meet. Windows in a row with one anchor
   form a segment (about 3 per 100 bytes), and only (anchor, segment hash,
   place) is shuffled, packed per bucket. Equal segments are settled at once:
   all but the earliest go. Tasks do this before the shuffle, too, so a group
   of copies costs one entry per task.
2. Where an anchor has different segments, the bytes of the earliest of each
   are fetched and every shard of them gets a suffix array by Larsson-Sadakane
   refinement: groups of suffixes with a common prefix are sorted by the rank
   of what follows, the prefix doubles, and suffixes that stand alone drop out.
   Neighbours whose common prefix reaches `length` are repeats. Shards of one
   bucket are merged by binary search of their windows, in sorted order.
   Anchors with more than `hot` segments are dealt out by window instead, after
   each task has merged its equal windows.
3. The intervals found are joined to the texts and cut out.

Common prefixes are only asked whether they reach `length`, so they are read
from word comparisons of neighbours, which numpy does at once, and not by
Kasai's scan, which is sequential.

Defined results: a null text is empty bytes; rows that repeat an id and text
are one document and each get its answer; rows of one id with different texts
are ordered by a hash of the text; a null id comes first; texts shorter than
`length` lose nothing; no documents, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.functions.scale import cut_light as cut
from corpusgraph.llm.common import BINARY, LONG, U64, bounded_batches, buffers, mix, powers, record, slices

KGRAM = 32
_PLACE = U64((1 << 28) - 1)
#: Segments of one bucket, bytes of one shard, and segments of one anchor beyond which windows are dealt out singly.
BUCKET_ENTRIES = 400_000
SHARD_BYTES = 1 << 20
HOT = 4_000
#: Bytes of text whose segments are packed together, and bytes of one text worked on at once.
PACK_BYTES = 24 << 20
BLOCK_BYTES = 1 << 20

_ODD = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407, 0x9FB21C651E98DF25)]

_BASE = 0x9FB21C651E98DF25
_BACK = pow(_BASE, -1, 1 << 64)


@cache
def _table(base: int, log: int) -> np.ndarray:
    return powers(base, 1 << log)


def _powers(base: int, n: int) -> np.ndarray:
    return _table(base, max(n - 1, 1).bit_length())[:n]


_PACKED = record(bucket=LONG, flags=BINARY, anchor=BINARY, segment=BINARY, doc=BINARY, tie=BINARY, lo=BINARY, hi=BINARY)
#: kind 0: remove [lo, hi); kind 1: compare windows lo..hi of an anchor; kind 2: the same for a hot anchor.
_FOUND = record(kind=LONG, anchor=LONG, doc=LONG, tie=LONG, lo=LONG, hi=LONG)
_SEGMENT = record(bucket=LONG, doc=LONG, tie=LONG, lo=LONG, body=BINARY)
_SPAN = record(doc=LONG, tie=LONG, lo=LONG, hi=LONG)


def segments(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """anchor hash, segment hash, text number, first and last window start (places in `data`)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(U64), none.astype(U64), none, none, none
    value = data.astype(U64) + U64(1)
    span, levels = 1, {}
    for odd in _ODD:
        value = value[:-span] * odd + value[span:]
        span *= 2
        if span >= KGRAM:
            levels[span] = value
    gram, wide = mix(levels[KGRAM]), levels[64]
    low = (gram & ~_PLACE) | np.arange(len(gram), dtype=U64)
    reach, width = low, 1
    need = length - KGRAM + 1
    while 2 * width <= need:
        reach = np.minimum(reach[:-width], reach[width:])
        width *= 2
    if width < need:
        reach = np.minimum(reach[: len(reach) - (need - width)], reach[need - width :])
    chosen = (reach & _PLACE).astype(np.int64)  # one per window start
    whole = np.zeros(n + 1, np.int32)
    size = np.diff(at)
    long = size >= length
    np.add.at(whole, at[:-1][long], 1)
    np.add.at(whole, at[1:][long] - length + 1, -1)
    valid = np.cumsum(whole[: len(chosen)]) > 0
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (chosen[1:] != chosen[:-1])
    close = valid.copy()
    close[:-1] &= ~valid[1:] | (chosen[1:] != chosen[:-1])
    lo, hi = np.flatnonzero(begin), np.flatnonzero(close)
    end = hi + length
    mark = wide[lo] * _ODD[0] + wide[lo + length - 64] * _ODD[1] + wide[end - length] * _ODD[2] + wide[end - 64] * _ODD[3]
    # A polynomial over all bytes, so that no part of a longer segment goes unseen.
    sums = np.concatenate((np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * _powers(_BASE, n), dtype=U64)))
    mark = mix(mark + (sums[end] - sums[lo]) * _powers(_BACK, n)[lo] + (hi - lo).astype(U64))
    return gram[chosen[lo]], mark, np.searchsorted(at, lo, side="right") - 1, lo, hi


def _blocks(data: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, borders, text number and offset of parts; a very long text comes in overlapping parts."""
    if len(data) <= 2 * BLOCK_BYTES or len(at) > 2:
        yield data, at, np.arange(len(at) - 1), np.zeros(len(at) - 1, np.int64)
        return
    for lo in range(0, len(data), BLOCK_BYTES):
        part = data[lo : lo + BLOCK_BYTES + length - 1]
        yield part, np.array([0, len(part)]), np.zeros(1, np.int64), np.array([lo])


def _merged(doc: np.ndarray, tie: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals [lo, hi) of each document, touching ones made one."""
    if not len(lo):
        return doc, tie, lo, hi
    order = np.lexsort((hi, lo, tie, doc))
    doc, tie, lo, hi = doc[order], tie[order], lo[order], hi[order]
    fresh = np.ones(len(lo), bool)
    border = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    group = np.concatenate(([0], np.cumsum(border)))
    # A running maximum inside each document: ranks of (group, hi) grow with the group.
    top = np.maximum.accumulate(group * (int(hi.max()) + 1) + hi) - group * (int(hi.max()) + 1)
    fresh[1:] = border | (lo[1:] > top[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(lo)) - 1
    return doc[first], tie[first], lo[first], top[last]


def _first_of_equal(anchor, segment, doc, tie, lo, hi) -> tuple[list[np.ndarray], np.ndarray]:
    """All columns in order of (anchor, segment, document, place), and which entries are the earliest of their kind."""
    order = np.lexsort((lo, tie, doc, segment, anchor))
    columns = [c[order] for c in (anchor, segment, doc, tie, lo, hi)]
    if len(order):  # a repeated row is the same document: its places count once
        other = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in columns], axis=0)))
        columns = [c[other] for c in columns]
    first = np.ones(len(columns[0]), bool)
    first[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    return columns, first


def _anchored(docs: DataFrame, length: int, n_buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            columns, first = _first_of_equal(*[np.concatenate(c) for c in zip(*held, strict=True)])
            again = ~first
            gone = _merged(*[c[again] for c in columns[2:5]], columns[5][again] + length)
            columns = [c[first] for c in columns]
            bucket = (columns[0] % U64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            columns = [c[order] for c in columns]
            step = max(1, len(gone[0]) // 64)
            for lo in range(0, len(gone[0]), step):
                own = np.stack([c[lo : lo + step] for c in gone]).astype(np.int64).tobytes()
                empty = pa.array([b""], pa.binary())
                where = pa.array([(lo // step) % n_buckets], pa.int64())
                yield pa.RecordBatch.from_arrays([where, pa.array([own], pa.binary()), *[empty] * 6], names=_PACKED.names)
            for lo in range(0, n_buckets, 64):
                rows = [b for b in range(lo, min(lo + 64, n_buckets)) if edges[b] < edges[b + 1]]
                if rows:
                    parts = [pa.array([c[edges[b] : edges[b + 1]].tobytes() for b in rows], pa.binary()) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows, pa.int64()), pa.array([b""] * len(rows), pa.binary()), *parts], names=_PACKED.names
                    )

        for batch in batches:
            for part in slices(batch, 2, BLOCK_BYTES):
                ids, ties = (part.column(i).to_numpy() for i in (0, 1))
                for data, at, text, base in _blocks(*buffers(part.column(2)), length):
                    anchor, segment, own, lo, hi = segments(data, at, length)
                    if len(lo):
                        shift = base[own] - at[own]
                        doc = text[own]
                        held.append((anchor, segment, ids[doc], ties[doc], lo + shift, hi + shift))
                    size += len(data)
                if size > PACK_BYTES and held:
                    yield from packed()
                    held, size = [], 0
        if held:
            yield from packed()

    return docs.mapInArrow(run, _PACKED)


def _settle(packed: DataFrame, length: int, hot: int) -> DataFrame:
    """Removals among equal segments, and the segments whose windows must be compared."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64)
        parts: list[list[np.ndarray]] = [[] for _ in kinds]
        for batch in batches:
            for x in batch.column(1):
                raw = np.frombuffer(x.as_buffer(), np.int64)
                if len(raw):
                    yield _found(0, None, *raw.reshape(4, -1))
            for i, kind in enumerate(kinds):
                parts[i] += [np.frombuffer(x.as_buffer(), kind) for x in batch.column(i + 2)]
        columns, first = _first_of_equal(*[np.concatenate(p) for p in parts])
        if not len(first):
            return
        again = ~first
        yield _found(0, None, *_merged(*[c[again] for c in columns[2:5]], columns[5][again] + length))
        anchor, _, doc, tie, lo, hi = (c[first] for c in columns)
        begin = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        count = np.diff(np.append(np.flatnonzero(begin), len(anchor)))
        count = np.repeat(count, count)
        for kind, own in ((1, (count > 1) & (count <= hot)), (2, count > hot)):
            for at in np.array_split(np.flatnonzero(own), max(1, int(own.sum()) // 50_000)):
                yield _found(kind, anchor[at].astype(np.int64), doc[at], tie[at], lo[at], hi[at])

    return packed.groupBy("bucket").applyInArrow(run, _FOUND)


def _found(kind: int, anchor, doc, tie, lo, hi) -> pa.RecordBatch:
    n = len(lo)
    anchor = np.zeros(n, np.int64) if anchor is None else anchor
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in (np.full(n, kind), anchor, doc, tie, lo, hi)], names=_FOUND.names)


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first `depth` bytes or more; Larsson-Sadakane refinement."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    key = np.zeros(n, U64)
    for k in range(8):
        key = (key << U64(8)) | padded[k : k + n].astype(U64)
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    # A suffix's rank is the last place of its group, as long as the group is unsorted.
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    group = np.append(np.flatnonzero(fresh)[1:], n) - 1
    rank[order] = np.repeat(group, np.diff(np.append(np.flatnonzero(fresh), n)))
    h = 8
    while h < depth:
        alone = fresh & np.append(fresh[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        own = order[open_]
        after = rank[np.minimum(own + h, n)]
        inner = np.lexsort((after, rank[own]))
        own, after = own[inner], after[inner]
        order[open_] = own
        old = rank[own]
        split = np.ones(len(own), bool)
        split[1:] = (old[1:] != old[:-1]) | (after[1:] != after[:-1])
        fresh[open_] |= split
        begin = np.flatnonzero(split)
        last = np.append(begin[1:], len(own)) - 1
        rank[own] = np.repeat(open_[last], np.diff(np.append(begin, len(own))))
        h *= 2
    return order


def common_prefix_reaches(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in order: does it share `length` bytes with the one before it?"""
    n = len(data)
    padded = np.concatenate((data, np.zeros(length, np.uint8)))
    out = np.zeros(len(order), bool)
    if len(order) < 2:
        return out
    here, before = order[1:], order[:-1]
    alive = np.flatnonzero((here + length <= n) & (before + length <= n))
    for k in range(length):
        alive = alive[padded[here[alive] + k] == padded[before[alive] + k]]
    out[alive + 1] = True
    return out


def _shard(bodies: list[bytes], doc: np.ndarray, tie: np.ndarray, lo: np.ndarray, length: int):
    """Windows of a shard in sorted order: their bytes, document, tie, start, and whether each equals the one before."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.array([len(b) for b in bodies])
    base = np.cumsum(size) - size
    order = suffix_array(data, length)
    owner = np.repeat(np.arange(len(bodies)), size)
    inner = order - base[owner[order]]
    order = order[inner + length <= size[owner[order]]]
    same = common_prefix_reaches(data, order, length)
    own = owner[order]
    return data, order, doc[own], tie[own], lo[own] + order - base[own], same


def _repeats(segments_: DataFrame, length: int) -> DataFrame:
    """Places of windows that also start earlier, as intervals to remove."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = np.zeros((0, length), np.uint8).view(f"V{length}").ravel()
        first = np.zeros((3, 0), np.int64)  # document, tie, start of the earliest of each known window

        def settle(bodies, doc, tie, lo) -> Iterator[pa.RecordBatch]:
            nonlocal text, first
            data, order, doc, tie, start, same = _shard(bodies, np.array(doc), np.array(tie), np.array(lo), length)
            if not len(order):
                return
            group = np.cumsum(~same)
            inside = np.lexsort((start, tie, doc, group))
            doc, tie, start, group, order = doc[inside], tie[inside], start[inside], group[inside], order[inside]
            lead = np.concatenate(([True], group[1:] != group[:-1]))
            gone = [(doc[~lead], tie[~lead], start[~lead])]
            mine = np.array([doc[lead], tie[lead], start[lead]])
            windows = np.lib.stride_tricks.sliding_window_view(data, length)[order[lead]]
            windows = np.ascontiguousarray(windows).view(f"V{length}").ravel()
            # Binary search among the windows of earlier shards: both sides are sorted.
            keys = _sortable(windows)
            known = _sortable(text)
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            met = (known[at] == keys) if len(known) else np.zeros(len(keys), bool)
            earlier = _before(mine[:, met], first[:, at[met]])
            loser = np.where(earlier, first[:, at[met]], mine[:, met])
            gone.append(tuple(loser))
            first[:, at[met]] = np.where(earlier, mine[:, met], first[:, at[met]])
            new = ~met
            place = np.searchsorted(known, keys[new])
            text = np.insert(text, place, windows[new])
            first = np.insert(first, place, mine[:, new], axis=1)
            doc, tie, start = (np.concatenate(c) for c in zip(*gone, strict=True))
            doc, tie, lo, hi = _merged(doc, tie, start, start + length)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc, tie, lo, hi)], names=_SPAN.names)

        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in (4, 1, 2, 3)], strict=True):
                held.append(row)
                size += len(row[0])
                if size > SHARD_BYTES:
                    yield from settle(*zip(*held, strict=True))
                    held, size = [], 0
        if held:
            yield from settle(*zip(*held, strict=True))

    return segments_.groupBy("bucket").applyInArrow(run, _SPAN)


def _sortable(windows: np.ndarray) -> np.ndarray:
    """Windows as byte strings, which compare like bytes; a final 1 keeps zeros at the end apart from padding."""
    width = windows.dtype.itemsize
    out = np.ones((len(windows), width + 1), np.uint8)
    out[:, :width] = windows.view(np.uint8).reshape(len(windows), width)
    return out.view(f"S{width + 1}").ravel()


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[0] < b[0]) | ((a[0] == b[0]) & ((a[1] < b[1]) | ((a[1] == b[1]) & (a[2] < b[2]))))


def _fetch(asked: DataFrame, docs: DataFrame, length: int, n_buckets: int) -> DataFrame:
    """Bytes of the asked segments; windows of hot anchors one by one, equal ones of a task merged."""
    lists = asked.groupBy("doc", "tie").agg(F.collect_list(F.struct("kind", "anchor", "lo", "hi")).alias("asked"))
    rows = docs.join(lists, ["doc", "tie"]).select("doc", "tie", "asked", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single: dict[bytes, tuple[int, int, int]] = {}
        losers: list[tuple] = []
        for batch in batches:
            out = []
            for doc, tie, wanted, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                raw = text.encode()
                for w in wanted:
                    if w["kind"] == 1:
                        out.append((w["anchor"] % n_buckets, doc, tie, w["lo"], raw[w["lo"] : w["hi"] + length]))
                        continue
                    for start in range(w["lo"], w["hi"] + 1):
                        body, place = raw[start : start + length], (doc, tie, start)
                        first = single.setdefault(body, place)
                        if place != first:
                            single[body] = min(place, first)
                            losers.append(max(place, first))
            if losers:
                out += [(-1, *place, b"") for place in losers]
                losers = []
            if len(single) > 50_000:
                out += _singles(single, n_buckets)
                single = {}
            yield _rows(out)
        yield _rows(_singles(single, n_buckets))

    return rows.mapInArrow(run, _SEGMENT)


def _singles(single: dict[bytes, tuple[int, int, int]], n_buckets: int) -> list[tuple]:
    import zlib

    return [(zlib.crc32(body) % n_buckets, *place, body) for body, place in single.items()]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [[]] * 5
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_SEGMENT.names)


KEPT = T.StructType([
    T.StructField("doc_id", LONG), T.StructField("n_bytes", LONG),
    T.StructField("spans", T.ArrayType(record(start=LONG, end=LONG))), T.StructField("kept", BINARY),
])


def _cut_out(docs: DataFrame, spans: DataFrame) -> DataFrame:
    lists = spans.groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("gone"))
    rows = docs.join(lists, ["doc", "tie"], "left").select("doc_id", "text", "gone")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sizes, spans_, kept = [], [], []
                for text, gone in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    raw = (text or "").encode()
                    own: list[list[int]] = []
                    for lo, hi in sorted((g["lo"], g["hi"]) for g in gone or ()):
                        if own and lo <= own[-1][1]:
                            own[-1][1] = max(own[-1][1], hi)
                        else:
                            own.append([lo, hi])
                    edges = [0, *[x for span in own for x in span], len(raw)]
                    sizes.append(len(raw))
                    spans_.append([{"start": a, "end": b} for a, b in own])
                    kept.append(b"".join([raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)]))
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(spans_, kind), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=KEPT.names)

    return rows.mapInArrow(run, KEPT)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = 100, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of maximal removed runs of bytes), kept (bytes that remain); one row per document."""
    if length < 64:
        raise ValueError("strings of at least 64 bytes")
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("text"))
    docs = docs.withColumn("doc", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("tie", F.xxhash64("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = 1 + int(total * 0.03) // BUCKET_ENTRIES

    found = cut(_settle(_anchored(docs.select("doc", "tie", "text"), length, n_buckets), length, hot))
    asked = found.filter("kind > 0").drop_duplicates(["kind", "anchor", "doc", "tie", "lo", "hi"])
    volume = asked.agg(F.sum(F.when(F.col("kind") == 1, F.col("hi") - F.col("lo") + length).otherwise((F.col("hi") - F.col("lo") + 1) * length))).first()[0] or 0
    gone = found.filter("kind = 0").select("doc", "tie", "lo", "hi")
    if volume:
        bodies = cut(_fetch(asked, docs.select("doc", "tie", "text"), length, 1 + volume // SHARD_BYTES))
        windows = bodies.filter("bucket >= 0").dropDuplicates(["bucket", "doc", "tie", "lo", "body"])
        early = bodies.filter("bucket < 0").select("doc", "tie", "lo", (F.col("lo") + length).alias("hi"))
        gone = gone.unionByName(early).unionByName(_repeats(windows, length))
    return _cut_out(docs.select("doc_id", "doc", "tie", "text"), gone)
