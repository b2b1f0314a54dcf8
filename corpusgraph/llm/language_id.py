"""Language identification with a bidirectional gated recurrent network over bytes.

Every byte of a text is read forwards and backwards by a small gated recurrent
unit; at each position both states give language probabilities, and a document
takes their mean over all its positions. The network is trained in numpy by
backpropagation through time with Adam steps, on windows of a sample whose
size is a parameter. Labelling covers whole texts: they are cut into windows
of `WINDOW` bytes that run side by side as columns of one matrix, each window
starting from a zero state, so time and memory do not depend on how long a
text is.

Gates use a piecewise linear sigmoid. Defined results: a null text, or one
without any letter, is `und` with score 0; a text is judged by all its bytes;
equal texts get equal answers; without labelled texts everything is `und`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.functions.scale import cut_light as cut
from corpusgraph.llm.common import BINARY, DOUBLE, LONG, STRING, U64, annotate, bounded_batches, buffers, mix, quoted, record, slices

HIDDEN = 6
WINDOW = 64
#: Different texts to learn from, at most, and windows from each.
SAMPLE = 2000
PIECES = 32
RESULT = record(lang_pred=STRING, score=DOUBLE)
_PIECES = record(lang=STRING, key=LONG, pieces=T.ArrayType(BINARY))
UNKNOWN = "und"


class Network(NamedTuple):
    """Weights of both directions, stacked on the first axis: 0 forwards, 1 backwards.

    Gate order is update, reset, candidate.
    """

    table: np.ndarray  # (2, 256, 3h): what each byte adds to the gates
    gates: np.ndarray  # (2, h, 2h)
    candidate: np.ndarray  # (2, h, h)
    out: np.ndarray  # (2, h, k)
    bias: np.ndarray  # (k,)
    langs: tuple[str, ...]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0.0, 1.0)


def start(langs: tuple[str, ...], hidden: int = HIDDEN, seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    h, k = hidden, len(langs)
    return Network(normal(2, 256, 3 * h), normal(2, h, 2 * h), normal(2, h, h), normal(2, h, k), np.zeros(k, np.float32), langs)


def _run(net: Network, side: int, codes: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """States along the window; codes is (steps, windows), already in reading order."""
    h = net.candidate.shape[1]
    state = np.zeros((codes.shape[1], h), np.float32)
    steps = []
    for code in codes:
        given = net.table[side][code]
        inner = given[:, : 2 * h] + state @ net.gates[side]
        gate = _sigmoid(inner)
        update, reset = gate[:, :h], gate[:, h:]
        held = reset * state
        fresh = np.tanh(given[:, 2 * h :] + held @ net.candidate[side])
        after = state + update * (fresh - state)
        steps.append((state, inner, update, reset, held, fresh, after))
        state = after
    return steps


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def gradients(net: Network, codes: np.ndarray, target: np.ndarray, real: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all real positions, and its gradient for each weight array."""
    steps = [_run(net, 0, codes), _run(net, 1, codes[::-1])]
    t = len(codes)
    states = [np.stack([s[-1] for s in steps[0]]), np.stack([s[-1] for s in steps[1]])[::-1]]
    chance = _softmax(states[0] @ net.out[0] + states[1] @ net.out[1] + net.bias)
    weight = real / real.sum()
    picked = np.take_along_axis(chance, np.broadcast_to(target[None, :, None], (*chance.shape[:2], 1)), 2)[..., 0]
    loss = float(-(np.log(picked + 1e-9) * weight).sum())
    error = chance * weight[..., None]
    np.put_along_axis(
        error, np.broadcast_to(target[None, :, None], (*chance.shape[:2], 1)), ((picked - 1) * weight)[..., None], 2
    )
    grads = [np.zeros_like(w) for w in net[:5]]
    grads[4] += error.sum((0, 1))
    h = net.candidate.shape[1]
    for side in (0, 1):
        grads[3][side] += np.einsum("tbh,tbk->hk", states[side], error)
        back = error @ net.out[side].T
        if side:
            back = back[::-1]
        order = codes if side == 0 else codes[::-1]
        flow = np.zeros_like(back[0])
        for i in range(t - 1, -1, -1):
            state, inner, update, reset, held, fresh, _ = steps[side][i]
            d = flow + back[i]
            d_fresh = d * update * (1 - fresh * fresh)
            d_held = d_fresh @ net.candidate[side].T
            slope = np.where(np.abs(inner) < 2.0, 0.25, 0.0).astype(np.float32)
            d_gate = np.concatenate((d * (fresh - state), d_held * state), 1) * slope
            grads[2][side] += held.T @ d_fresh
            grads[1][side] += state.T @ d_gate
            np.add.at(grads[0][side], order[i], np.concatenate((d_gate, d_fresh), 1))
            flow = d * (1 - update) + d_held * reset + d_gate @ net.gates[side].T
    return loss, grads


def windows(data: np.ndarray, at: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (width, n), real bytes (n,) and the text of each window; a text's last window is filled with blanks."""
    size = np.diff(at)
    per = -(-size // width)
    owner = np.repeat(np.arange(len(size)), per)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin = at[owner] + inside * width
    real = np.minimum(width, at[owner + 1] - begin) if len(owner) else np.zeros(0, np.int64)
    codes = np.full((len(owner), width), 32, np.uint8)
    full = np.arange(width) < real[:, None]
    codes[full] = data  # windows lie in the order of the bytes
    return np.ascontiguousarray(codes.T), real, owner


def train(
    texts: list[str] | list[bytes], targets: list[str], *, steps: int = 240, batch: int = 192, width: int = WINDOW, rate: float = 0.02, seed: int = 5
) -> Network | None:
    """Adam steps on random windows of the texts, languages equally often."""
    langs = tuple(sorted(set(targets)))
    pool: list[list[tuple[np.ndarray, int]]] = [[] for _ in langs]
    for text, lang in zip(texts, targets, strict=True):
        raw = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
        if len(raw):
            pool[langs.index(lang)].append((raw, len(raw)))
    held = [k for k, p in enumerate(pool) if p]
    if not held:
        return None
    net = start(langs)
    rng = np.random.default_rng(seed)
    moment = [np.zeros_like(w) for w in net[:5]]
    square = [np.zeros_like(w) for w in net[:5]]
    for step in range(1, steps + 1):
        codes, real = np.full((width, batch), 32, np.uint8), np.zeros((width, batch), np.float32)
        target = rng.choice(held, batch)
        for b, k in enumerate(target):
            raw, n = pool[k][rng.integers(len(pool[k]))]
            at = rng.integers(max(1, n - width + 1))
            piece = raw[at : at + width]
            codes[: len(piece), b] = piece
            real[: len(piece), b] = 1
        _, grads = gradients(net, codes, target, real)
        pace = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(net[:5], grads, moment, square, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _states(net: Network, side: int, codes: np.ndarray, logits: np.ndarray, reverse: bool) -> None:
    """Add one direction's share of the logits at every position; all matrices are (units, windows)."""
    h = net.candidate.shape[1]
    # 0.25 x + 0.5 is folded into the gate weights.
    table = net.table[side].T.copy()
    table[: 2 * h] = 0.25 * table[: 2 * h] + 0.5
    table = np.ascontiguousarray(table.T)
    gates, candidate, out = np.ascontiguousarray(0.25 * net.gates[side].T), np.ascontiguousarray(net.candidate[side].T), np.ascontiguousarray(net.out[side].T)
    n = codes.shape[1]
    state, gate, held, fresh = (np.zeros((r, n), np.float32) for r in (h, 2 * h, h, h))
    for i in range(len(codes) - 1, -1, -1) if reverse else range(len(codes)):
        given = table[codes[i]].T
        np.matmul(gates, state, out=gate)
        gate += given[: 2 * h]
        np.clip(gate, 0.0, 1.0, out=gate)
        np.multiply(gate[h:], state, out=held)
        np.matmul(candidate, held, out=fresh)
        fresh += given[2 * h :]
        np.tanh(fresh, out=fresh)
        fresh -= state
        fresh *= gate[:h]
        state += fresh
        logits[i] += out @ state


def label(net: Network, data: np.ndarray, at: np.ndarray, block: int = 8192) -> np.ndarray:
    """Mean language probabilities over all positions of each text; (texts, languages)."""
    k = len(net.langs)
    sums = np.zeros((len(at) - 1, k))
    codes, real, owner = windows(data, at)
    for lo in range(0, len(owner), block):
        part = codes[:, lo : lo + block]
        logits = np.empty((len(part), k, part.shape[1]), np.float32)
        logits[:] = net.bias[:, None]
        _states(net, 0, part, logits, False)
        _states(net, 1, part, logits, True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        short = np.flatnonzero(real[lo : lo + block] < len(part))
        for b in short:
            logits[real[lo + b] :, :, b] = 0
        own = logits.sum(0, dtype=np.float64).T
        np.add.at(sums, owner[lo : lo + block], own)
    return sums / np.maximum(np.diff(at), 1)[:, None]


def pieces(text: bytes, key: int, width: int = WINDOW, n: int = PIECES) -> list[bytes]:
    """`n` windows at places hashed from the key, over the whole text; a short text is its own window each time."""
    places = mix(np.arange(n, dtype=U64) + U64(key % (1 << 64))) % U64(max(1, len(text) - width + 1))
    return [text[at : at + width] for at in places.tolist()]


def learn(docs: DataFrame, *, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Network | None:
    """Network from at most `sample` different labelled texts, an exact like share of each language (one at least), chosen by a hash.

    Only windows of the chosen texts, from anywhere in them, come to the driver.
    """
    known = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    keyed = known.dropna().filter(F.col("text").rlike(r"\p{L}")).withColumn("key", F.xxhash64("text"))
    # Copies count once.
    keys = cut(keyed.select("lang", "key").distinct())
    counts = {r["lang"]: r["count"] for r in keys.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = max(1, sample // len(counts))
    # Different keys are uniform, so a bound on them leaves few rows for the exact cut, but surely the share.
    bound = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, (2 * share + 40) / n)))])
    place = (F.col("key").cast("double") / 2.0**63 + 1) / 2
    ranked = keys.filter(place <= F.try_element_at(bound, F.col("lang")))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key")))
    chosen = {(r["lang"], r["key"]) for r in ranked.filter(F.col("rank") <= share).collect()}
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                rows = zip(*(part.column(i).to_pylist() for i in range(3)), strict=True)
                out = [(x, k, pieces(t.encode(), k)) for x, k, t in rows if (x, k) in chosen]
                if out:
                    kinds = (pa.string(), pa.int64(), pa.list_(pa.binary()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=_PIECES.names)

    texts = keyed.filter(F.col("key").isin([k for _, k in chosen])).select("lang", "key", "text")
    rows = texts.mapInArrow(run, _PIECES).dropDuplicates(["lang", "key"]).orderBy("lang", "key").collect()
    return train([bytes(p) for r in rows for p in r["pieces"]], [r["lang"] for r in rows for _ in r["pieces"]])


def _worker(net: Network | None) -> Callable[[pa.Array], pa.Array]:
    def work(texts: pa.Array) -> pa.Array:
        data, at = buffers(texts)
        names = np.full(len(texts), UNKNOWN, object)
        score = np.zeros(len(texts))
        if net is not None and len(data):
            # Equal texts of a batch are labelled once.
            plain = texts.to_pylist()
            order: dict[str, int] = {}
            which = np.array([order.setdefault(t or "", len(order)) for t in plain])
            one = pa.array(list(order), pa.string())
            chance = label(net, *buffers(one))[which]
            best = chance.argmax(1)
            full = np.diff(at) > 0
            names[full] = np.array(net.langs, object)[best[full]]
            score[full] = chance.max(1)[full]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    return work


def identify(
    docs: DataFrame, net: Network | None, *, text: str = "text", into: str = "language", keep: list[str] | None = None
) -> DataFrame:
    """Documents with a struct `into`: lang_pred and score (0 to 1)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != into]
    shared = docs.sparkSession.sparkContext.broadcast(net)
    # Texts without a letter are not sent to the network at all.
    read = "_read"
    while read in keep:
        read += "_"
    letters = F.when(F.col(f"`{text}`").cast("string").rlike(r"\p{L}"), F.col(f"`{text}`"))
    return annotate(docs.select(*quoted(keep), letters.alias(read)), read, lambda: _worker(shared.value), RESULT, into, keep)
