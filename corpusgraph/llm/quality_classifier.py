"""Quality classifier: logistic regression over hashed word n-grams.

Features of a text are its words and pairs of neighbouring words, and the
shapes of words (capital, small, digit and other runs) with their pairs, each
hashed into `size` places. Follow-the-regularised-leader updates learn the
weights from a sample of labelled texts whose size is a parameter; scoring is
a sparse dot product over the whole text inside Arrow batches, with a weight
vector of fixed size.

Defined results: a null or empty text has no features and gets the score of
the bias alone; labels that are null, and labels of documents that are not
there, teach nothing; without labels every score is 0.5; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.common import DOUBLE, NOT_BLANK, SAME, U64, annotate, buffers, mix, words

#: Places for features; the weights are one vector of this length.
SIZE = 1 << 18
#: Labelled documents to learn from, at most; every document is scored.
SAMPLE = 4000

_SHAPE = np.full(256, 1, np.uint8)
_SHAPE[48:58] = 2
_SHAPE[97:123] = 3
_SHAPE[128:] = 3
_SHAPE[65:91] = 4
_STEP = U64(0xC2B2AE3D27D4EB4F)


def features(data: np.ndarray, at: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of all texts end to end, and the number of features of each text."""
    found = words(data, at, NOT_BLANK, SAME)
    n = len(found.hash)
    counts = np.diff(found.first)
    doc = np.repeat(np.arange(len(counts)), counts)
    # A word's shape: kinds of its first, second and last bytes and whether it is long.
    length = found.end - found.start
    kinds = _SHAPE[data]
    last = found.end - 1
    shape = np.zeros(n, np.int64)
    for place in (found.start, np.minimum(found.start + 1, last), np.maximum(last - 1, found.start), last):
        shape = shape * 5 + kinds[place]
    shape = mix((shape * 8 + np.minimum(length, 7)).astype(U64) + U64(77))
    parts, owners = [], []
    for value in (found.hash, shape):
        parts.append(value)
        owners.append(doc)
        if n > 1:
            pair = mix(value[:-1] * _STEP + value[1:])
            inside = doc[:-1] == doc[1:]
            parts.append(pair[inside])
            owners.append(doc[:-1][inside])
    places = (np.concatenate(parts) >> U64(64 - int(size).bit_length() + 1)).astype(np.int64) if n else np.zeros(0, np.int64)
    owner = np.concatenate(owners) if n else np.zeros(0, np.int64)
    return places, owner


def logits(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Weighted features over the square root of their number, so that long texts do not saturate."""
    data, at = buffers(texts)
    places, owner = features(data, at, len(weights))
    total = np.bincount(owner, weights[places], len(texts))
    number = np.bincount(owner, minlength=len(texts))
    return bias + total / np.sqrt(np.maximum(number, 1))


def train(
    texts: list[str | None], labels: list[int], *, size: int = SIZE, passes: int = 3, alpha: float = 0.1, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.1, seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-proximal updates, one text at a time."""
    z, squares = np.zeros(size + 1), np.zeros(size + 1)
    rows = []
    for text in texts:
        data, at = buffers(pa.array([text], pa.string()))
        places, _ = features(data, at, size)
        own, count = np.unique(places, return_counts=True)
        rows.append((np.append(own, size), np.append(count / np.sqrt(max(1, len(places))), 1.0)))

    def weight(own: np.ndarray) -> np.ndarray:
        pull, spread = z[own], squares[own]
        w = -(pull - np.sign(pull) * l1) / ((beta + np.sqrt(spread)) / alpha + l2)
        return np.where(np.abs(pull) <= l1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(passes if texts else 0):
        for i in order.permutation(len(rows)):
            own, value = rows[i]
            w = weight(own)
            guess = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            step = (guess - labels[i]) * value
            sigma = (np.sqrt(squares[own] + step * step) - np.sqrt(squares[own])) / alpha
            z[own] += step - sigma * w
            squares[own] += step * step
    final = weight(np.arange(size + 1))
    return final[:size].astype(np.float32), float(final[size])


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text divides by five; a null id is neither learned from nor held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def learn(
    docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> tuple[np.ndarray, float]:
    """Weights and bias from at most `sample` labelled documents outside the held-out fifth, chosen by a hash of the id."""
    known = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label")).dropna()
    known = known.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_label").alias("_label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    own = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    rows = own.join(chosen, "_id").select("_id", "_text", "_label").distinct().orderBy(F.xxhash64("_id"), "_id", "_text").limit(sample).toArrow()
    return train(rows.column("_text").to_pylist(), rows.column("_label").to_pylist())


def _scorer(weights: np.ndarray, bias: float) -> Callable[[pa.Array], pa.Array]:
    return lambda texts: pa.array(1 / (1 + np.exp(-np.clip(logits(texts, weights, bias), -35, 35))), pa.float64())


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], *, text: str = "text", into: str = "score", keep: list[str] | None = None
) -> DataFrame:
    """Documents with the probability of label 1 in column `into`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, text, lambda: _scorer(*shared.value), DOUBLE, into, keep)
