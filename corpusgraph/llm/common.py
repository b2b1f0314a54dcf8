"""Shared pieces: bounded Arrow batches, and words and n-grams hashed with numpy.

Texts reach Python as Arrow buffers. `words` works on the UTF-8 bytes of many
texts at once, so no Python object is made per word, and in blocks, so memory
beyond the batch itself does not depend on the length of a text.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handled at once inside a task, and rows in one Arrow batch.
SLICE_BYTES = 4 << 20
BATCH_ROWS = 500

U64 = np.uint64
_BLOCK = 1 << 20
_LOW, _HIGH = 12, 4096


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, so that very long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that are done: Spark deletes them once the driver's heap has been collected."""
    gc.collect()
    spark._jvm.System.gc()


def record(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


LONG, STRING, BINARY, DOUBLE, BOOL = T.LongType(), T.StringType(), T.BinaryType(), T.DoubleType(), T.BooleanType()


def quoted(names: Sequence[str]) -> list:
    return [F.col(f"`{n}`") for n in names]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and where each begins; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `limit` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    _, at = buffers(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def annotate(
    docs: DataFrame, text: str, make: Callable[[], Callable[[pa.Array], pa.Array]], kind: T.DataType, into: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add column `into`, computed from `text` in slices; a column of that name is replaced.

    `make` is called once per task and returns the function from texts to
    results. Only the columns in `keep` (default all) travel along.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != into]
    bounded_batches(docs.sparkSession)
    # Plain inner names cannot clash with the columns of any table.
    carried = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(keep)]
    source = docs.select(*carried, F.col(f"`{text}`").cast("string").alias("text"))
    kinds = [docs.schema[name].dataType for name in keep]
    names = [*keep, into]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, [*kinds, kind], strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, len(keep)):
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, work(part.column(len(keep)))], names=names)

    return source.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd number, as 64-bit words."""
    out = np.empty(n, U64)
    out[0] = 1
    done = 1
    while done < n:
        step = U64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out


_BASE = 0x9E3779B97F4A7C15
_WEIGHT = powers(_BASE, _HIGH)
_FAR = powers(pow(_BASE, _HIGH, 1 << 64), _HIGH)
_GRAM = powers(0xD6E8FEB86659FD93, 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)
#: Bytes inside words: all but space and the controls 9 to 13.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[32, *range(9, 14)]] = False
#: Letters, digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Words(NamedTuple):
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Of text i: words first[i] to first[i + 1].
    first: np.ndarray


def words(data: np.ndarray, at: np.ndarray, inside: np.ndarray, fold: np.ndarray = SAME) -> Words:
    """Maximal runs of bytes that `inside` marks, never across texts, hashed after `fold`."""
    n = len(data)
    hashes, starts, ends = [], [], []
    lo = 0
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    while lo < n:
        hi = min(n, lo + _BLOCK)
        while hi < n and inside[data[hi - 1]] and inside[data[hi]] and not edge[hi]:
            ahead = inside[data[hi : hi + _BLOCK]] & ~edge[hi : min(n, hi + _BLOCK)]
            stop = np.flatnonzero(~ahead)
            hi += int(stop[0]) if len(stop) else len(ahead)
        chunk = data[lo:hi]
        word = inside[chunk]
        before = np.empty(hi - lo, bool)
        before[0] = False
        before[1:] = word[:-1]
        first = np.flatnonzero(word & (~before | edge[lo:hi]))
        if len(first):
            after = np.empty(hi - lo, bool)
            after[-1] = False
            after[:-1] = word[1:]
            last = np.flatnonzero(word & (~after | edge[lo + 1 : hi + 1])) + 1
            size = last - first
            gone = first - np.concatenate(([0], np.cumsum(size)[:-1]))
            place = np.flatnonzero(word)
            byte = fold[chunk[place]].astype(U64)
            byte += U64(1)
            place -= np.repeat(gone, size)  # now 0, 1, 2, ... over all word bytes
            inner = place - np.repeat(np.cumsum(size) - size, size)
            if size.max() > _HIGH:
                byte *= _FAR[(inner >> _LOW) & (_HIGH - 1)]
            byte *= _WEIGHT[inner & (_HIGH - 1)]
            value = np.add.reduceat(byte, np.cumsum(size) - size)
            hashes.append(mix(value + size.astype(U64) * U64(0xA24BAED4963EE407)))
            starts.append(first + lo)
            ends.append(last + lo)
        lo = hi
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    end = np.concatenate(ends) if ends else none
    value = np.concatenate(hashes) if hashes else np.zeros(0, U64)
    return Words(value, start, end, np.searchsorted(start, at).astype(np.int64))


def grams(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of `n` words inside one text, and the number of its first word."""
    total = len(found.hash)
    if total < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    out = found.hash[: total - n + 1].copy()
    for k in range(1, n):
        out += found.hash[k : total - n + 1 + k] * _GRAM[k]
    whole = np.ones(total - n + 1, bool)
    for k in range(1, n):  # windows that begin in the last n - 1 words of a text run over its end
        cut = found.first[1:-1] - k
        whole[cut[(cut >= 0) & (cut < len(whole))]] = False
    where = np.flatnonzero(whole)
    return mix(out[where] + U64(n)), where


def sequence_hash(values: np.ndarray) -> np.ndarray:
    """The hash that `grams` would give to these words as one window."""
    return mix((values * _GRAM[: len(values)]).sum(dtype=U64)[None] + U64(len(values)))[0]
