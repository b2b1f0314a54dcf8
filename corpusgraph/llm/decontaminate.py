"""Benchmark decontamination.

Windows of n normalised words of every test item form a hash set that each
task holds; training texts are scanned window by window, hits are verified
word for word, and spans or documents can be removed.

Normalised words are the runs of ASCII letters (lower-cased), digits and
non-ASCII characters. An item with fewer than n words, but not none, is one
window. The set is broadcast in blocks of at most `block_bytes` of item text,
a documented bound: a larger benchmark takes more passes over the documents.

Defined results: a null or empty text has no words and is never contaminated;
items without words match nothing; an item with a null id marks words but is
not listed; repeated items count once by id; repeated documents are each
judged; no items or no documents give the plain empty answer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.llm.common import ALNUM, LONG, LOWER, STRING, annotate, buffers, grams, quoted, record, sequence_hash, words

RESULT = record(n_words=LONG, n_hit=LONG, items=T.ArrayType(STRING), clean=STRING)


class _Index:
    """Windows of some items: sorted hashes, and where each window stands in the items."""

    def __init__(self, rows: list[tuple[str | None, str | None]], n: int):
        self.n = n
        self.ids = [r[0] for r in rows]
        data, at = buffers(pa.array([r[1] for r in rows], pa.string()))
        found = words(data, at, ALNUM, LOWER)
        self.low = LOWER[data].tobytes()
        self.start, self.end = found.start, found.end
        value, where = grams(found, n)
        sizes = np.full(len(value), n)
        item = np.searchsorted(found.first, where, side="right") - 1
        short = [i for i, c in enumerate(np.diff(found.first)) if 0 < c < n]
        if short:
            extra = [found.hash[found.first[i] : found.first[i + 1]] for i in short]
            value = np.concatenate((value, [sequence_hash(x) for x in extra]))
            where = np.concatenate((where, found.first[short]))
            sizes = np.concatenate((sizes, [len(x) for x in extra]))
            item = np.concatenate((item, short))
        order = np.argsort(value, kind="stable")
        self.value, self.where, self.size, self.item = (x[order] for x in (value.astype(np.uint64), where, sizes, item))
        self.lengths = sorted(set(self.size.tolist()))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.value >> np.uint64(44)).astype(np.int64)] = True
        self.known: dict[int, dict[bytes, list[int]]] = {}

    def matches(self, value: int, window: bytes) -> list[int]:
        """Items that hold exactly this window."""
        if value not in self.known:
            lo, hi = (int(np.searchsorted(self.value, np.uint64(value), side)) for side in ("left", "right"))
            held: dict[bytes, list[int]] = {}
            for k in range(lo, hi):
                own = range(self.where[k], self.where[k] + self.size[k])
                text = b" ".join([self.low[self.start[w] : self.end[w]] for w in own])
                held.setdefault(text, []).append(int(self.item[k]))
            self.known[value] = held
        return self.known[value].get(window, [])


def _scanner(index: _Index, spans: bool) -> Callable[[pa.Array], pa.Array]:
    def scan(texts: pa.Array) -> pa.Array:
        data, at = buffers(texts)
        found = words(data, at, ALNUM, LOWER)
        marks = np.zeros(len(found.hash) + 1, np.int64)
        named: dict[int, set[str]] = {}
        for n in index.lengths:
            value, where = grams(found, n)
            maybe = np.flatnonzero(index.seen[(value >> np.uint64(44)).astype(np.int64)])
            value, where = value[maybe], where[maybe]
            near = np.minimum(np.searchsorted(index.value, value), len(index.value) - 1)
            sure = index.value[near] == value
            doc_of = np.searchsorted(found.first, where[sure], side="right") - 1
            for v, w, doc in zip(value[sure].tolist(), where[sure].tolist(), doc_of.tolist(), strict=True):
                own = [data[s:e] for s, e in zip(found.start[w : w + n], found.end[w : w + n], strict=True)]
                hit = index.matches(v, b" ".join([LOWER[x].tobytes() for x in own]))
                if hit:
                    marks[w] += 1
                    marks[w + n] -= 1
                    named.setdefault(doc, set()).update(index.ids[i] for i in hit if index.ids[i] is not None)
        hit = np.cumsum(marks)[:-1] > 0
        upto = np.concatenate(([0], np.cumsum(hit)))
        n_hit = upto[found.first[1:]] - upto[found.first[:-1]]
        clean = pa.nulls(len(texts), pa.string())
        if spans:
            clean = pa.array([_without(data, at, found, hit, d) if n_hit[d] else texts[d].as_py() for d in range(len(texts))], pa.string())
        items = pa.array([sorted(named.get(d, ())) for d in range(len(texts))], pa.list_(pa.string()))
        return pa.StructArray.from_arrays(
            [pa.array(np.diff(found.first)), pa.array(n_hit), items, clean], fields=list(pa.schema([
                ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("clean", pa.string())])),
        )

    return scan


def _without(data: np.ndarray, at: np.ndarray, found, hit: np.ndarray, doc: int) -> str:
    """Text without hit words, and without what stands between two hit words."""
    lo, hi = found.first[doc], found.first[doc + 1]
    gone = np.zeros(at[doc + 1] - at[doc], bool)
    for w in np.flatnonzero(hit[lo:hi]) + lo:
        stop = found.start[w + 1] if w + 1 < hi and hit[w + 1] else found.end[w]
        gone[found.start[w] - at[doc] : stop - at[doc]] = True
    return data[at[doc] : at[doc + 1]][~gone].tobytes().decode()


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int) -> list[DataFrame]:
    held = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    total = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    return [held.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k) for k in range(parts)]


def decontaminate(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 10,
    spans: bool = False, into: str = "leak", keep: list[str] | None = None, block_bytes: int = 16 << 20,
) -> DataFrame:
    """Documents with a struct `into`: n_words, n_hit, items (ids found), and with `spans` the clean text.

    A benchmark over the bound is scanned block by block; words hit in any block
    are then counted by their places, so the answer is the same.
    """
    blocks = _blocks(items, item_id, item_text, block_bytes)
    if len(blocks) == 1:
        index = _Index([tuple(r) for r in blocks[0].collect()], n)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        return annotate(docs, text, lambda: _scanner(shared.value, spans), RESULT, into, keep)
    return _many(docs, blocks, text, n, spans, into, keep)


def _many(docs, blocks, text, n, spans, into, keep) -> DataFrame:
    keep = [c for c in (docs.columns if keep is None else keep) if c != into]
    # The documents' columns travel inside one, so no name of theirs can clash with those below.
    out = docs.select(F.struct(*quoted(keep)).alias("kept"), F.col(f"`{text}`").cast("string").alias("whole"))
    parts = [f"part{k}" for k in range(len(blocks))]
    for part, block in zip(parts, blocks, strict=True):
        index = _Index([tuple(r) for r in block.collect()], n)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        out = annotate(out, "whole", lambda shared=shared: _placer(shared.value), PLACES, part)
    hits = F.array_sort(F.array_distinct(F.concat(*[F.col(f"{p}.hits") for p in parts])))
    names = F.array_sort(F.array_distinct(F.concat(*[F.col(f"{p}.items") for p in parts])))
    out = out.select("kept", "whole", hits.alias("hits"), names.alias("names"), F.col(f"{parts[0]}.n_words").alias("n"))
    clean = F.col("clean") if spans else F.lit(None).cast("string")
    if spans:
        out = out.withColumn("both", F.to_json(F.struct(F.col("whole").alias("t"), F.col("hits").alias("h"))))
        out = annotate(out, "both", lambda: _cutter, T.StringType(), "clean")
    result = F.struct(F.col("n").alias("n_words"), F.size("hits").cast("long").alias("n_hit"), F.col("names").alias("items"), clean.alias("clean"))
    return out.select("kept.*", result.alias(into))


PLACES = record(n_words=LONG, hits=T.ArrayType(LONG), items=T.ArrayType(STRING))


def _placer(index: _Index) -> Callable[[pa.Array], pa.Array]:
    scan = _scanner(index, False)

    def place(texts: pa.Array) -> pa.Array:
        out = scan(texts)
        hits = []
        data, at = buffers(texts)
        found = words(data, at, ALNUM, LOWER)
        for d in range(len(texts)):
            own: set[int] = set()
            if out.field("n_hit")[d].as_py():
                lo, hi = found.first[d], found.first[d + 1]
                one = type(found)(found.hash[lo:hi], found.start[lo:hi], found.end[lo:hi], np.array([0, hi - lo]))
                for n in index.lengths:
                    value, where = grams(one, n)
                    for v, w in zip(value.tolist(), where.tolist(), strict=True):
                        window = b" ".join([LOWER[data[one.start[k] : one.end[k]]].tobytes() for k in range(w, w + n)])
                        if index.matches(v, window):
                            own.update(range(w, w + n))
            hits.append(sorted(own))
        return pa.StructArray.from_arrays(
            [out.field("n_words"), pa.array(hits, pa.list_(pa.int64())), out.field("items")], names=["n_words", "hits", "items"]
        )

    return place


def _cutter(rows: pa.Array) -> pa.Array:
    import json

    cleaned = []
    for row in rows.to_pylist():
        whole = json.loads(row)
        if whole.get("t") is None:
            cleaned.append(None)
            continue
        data, at = buffers(pa.array([whole["t"]]))
        found = words(data, at, ALNUM, LOWER)
        hit = np.zeros(len(found.hash), bool)
        hit[whole.get("h") or []] = True
        cleaned.append(_without(data, at, found, hit, 0))
    return pa.array(cleaned, pa.string())
