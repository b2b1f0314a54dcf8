"""How familiar the letters of a text are: text in a known language against garbled or foreign text.

The network of `language_id` spreads one unit of probability over the languages
it knows, so its score says which of them, never whether it is any of them.
This counts letter trigrams of all labelled texts, per language, and gives a
text the mean of log2(probability of a trigram / chance) over its letters, for
the language that fits best: 0 bits are chance, whatever the languages are.

The least bits asked for come from labelled texts that were not counted: in each
class of lengths, the value that all but `RARE` of each language reach, moved half way
towards chance (or as far below it). Case, digits and signs do not count. A text without a letter has
no bits (null).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.llm.common import BOOL, DOUBLE, LONG, STRING, U64, annotate, bounded_batches, buffers, record, slices

#: Trigrams are counted in so many hashed places per language.
PLACES = 1 << 16
#: Share of labelled texts that may have fewer bits, and texts that a class needs for a bound of its own.
RARE = 0.001
LEAST = 30
#: One labelled text in so many is kept from the counts, to draw the bounds from.
APART = 4
RESULT = record(bits=DOUBLE, letters=LONG, clear=BOOL)
_COUNT = record(lang=STRING, place=LONG, n=LONG)

_FOLD = np.zeros(256, U64)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


class Familiar(NamedTuple):
    bits: np.ndarray  # (languages, PLACES): bits above chance
    least: np.ndarray  # least mean bits by length class; -inf where nothing can be told


def places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Place of the trigram around each letter byte, and the number of letter bytes up to each text's end."""
    lower = pa.array([(t or "").lower() for t in texts.to_pylist()], pa.string())
    data, at = buffers(lower)
    # A blank before each text and one at the very end part the texts.
    n = np.diff(at)
    code = np.zeros(len(data) + len(n) + 1, U64)
    shift = np.repeat(np.arange(1, len(n) + 1), n)
    spot = np.arange(len(data)) + shift
    code[spot] = _FOLD[data]
    middle = spot[code[spot] > 0]
    gram = (code[middle - 1] << U64(16)) | (code[middle] << U64(8)) | code[middle + 1]
    last = np.searchsorted(middle, at[1:] + np.arange(1, len(n) + 1))
    return ((gram * U64(0x9E3779B97F4A7C15)) >> U64(48)).astype(np.int64), last


def size_class(letters: np.ndarray) -> np.ndarray:
    """0 for none, else the number of binary digits."""
    return np.frexp(letters.astype(np.float64))[1]


def judge(known: Familiar, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Mean bits of the best language, nan without letters, and the letter bytes of each text."""
    place, last = places(texts)
    letters = np.diff(np.concatenate(([0], last)))
    best = np.full(len(letters), np.nan)
    full = letters > 0
    if full.any():
        begin = (last - letters)[full]
        sums = np.stack([np.add.reduceat(row[place], begin, dtype=np.float64) for row in known.bits])
        best[full] = sums.max(0) / letters[full]
    return best, letters


def _count(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                langs = np.array(part.column(0).to_pylist(), object)
                for lang in sorted(set(langs)):
                    n = np.bincount(places(part.column(1).filter(pa.array(langs == lang)))[0], minlength=1)
                    place = np.flatnonzero(n)
                    columns = [pa.array([lang] * len(place), pa.string()), pa.array(place, pa.int64()), pa.array(n[place], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=_COUNT.names)

    return docs.select("lang", "text").mapInArrow(run, _COUNT).groupBy("lang", "place").agg(F.sum("n").alias("n"))


def _apart() -> Column:
    """Equal texts fall on the same side."""
    return F.pmod(F.xxhash64("text"), F.lit(APART)) == 0


def _labelled(docs: DataFrame, text: str, lang: str) -> DataFrame:
    known = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    return known.dropna().filter(F.col("text").rlike(r"\p{L}"))


def uncounted(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang and text of the labelled texts that `learn` does not count."""
    return _labelled(docs, text, lang).filter(_apart())


def learn(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Familiar | None:
    """Trigrams and bounds from all labelled documents of the given ones; None without any."""
    counts = _count(_labelled(docs, text, lang).filter(~_apart())).toArrow()
    if not counts.num_rows:
        return None
    langs, which = np.unique(np.array(counts.column("lang").to_pylist(), object), return_inverse=True)
    n = np.zeros((len(langs), PLACES))
    n[which, counts.column("place").to_numpy()] = counts.column("n").to_numpy()
    bits = np.log2((n + 0.05) * PLACES / (n.sum(1, keepdims=True) + 0.05 * PLACES)).astype(np.float32)
    known = Familiar(bits, np.full(65, -np.inf))
    tested = find(uncounted(docs, text=text, lang=lang), known, into="f", keep=["lang"])
    return known._replace(least=least(tested, F.col("f.bits"), F.col("f.letters")))


def least(tested: DataFrame, above: Column, letters: Column) -> np.ndarray:
    """Least value by length class, for values `above` chance of labelled texts: half of what all but `RARE` of each language reach."""
    rows = tested.select("lang", F.length(F.bin(letters)).alias("digits"), above.alias("above")).dropna().groupBy("lang", "digits")
    rows = rows.agg(F.count("*").alias("n"), F.percentile_approx("above", F.lit(RARE), F.lit(10000)).alias("low")).collect()
    out = np.full(65, -np.inf)
    for own in range(1, 65):
        # A class of few texts takes shorter ones to it; where all these are few, nothing is rejected.
        shortest = next((k for k in range(own, 0, -1) if sum(r.n for r in rows if k <= r.digits <= own) >= LEAST), None)
        if shortest:
            low = min(r.low for r in rows if shortest <= r.digits <= own)
            out[own] = low - abs(low) / 2
    return out


def _worker(known: Familiar) -> Callable[[pa.Array], pa.Array]:
    def work(texts: pa.Array) -> pa.Array:
        bits, letters = judge(known, texts)
        clear = (letters > 0) & ~(bits < known.least[size_class(letters)])
        return pa.StructArray.from_arrays([pa.array(bits, from_pandas=True), pa.array(letters), pa.array(clear)], names=["bits", "letters", "clear"])

    return work


def find(docs: DataFrame, known: Familiar, *, text: str = "text", into: str = "familiar", keep: list[str] | None = None) -> DataFrame:
    """Documents with a struct `into`: bits, letters (letter bytes) and clear."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    return annotate(docs, text, lambda: _worker(shared.value), RESULT, into, keep)
