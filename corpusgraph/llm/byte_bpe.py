"""Byte-level BPE encoding and decoding.

A sentencepiece BPE model is serialised straight from the rank file: every
byte becomes one printable character, every vocabulary entry a piece scored by
its negative rank, with identity normalisation. Texts are cut into pre-tokens
by the public pattern; each distinct pre-token is encoded once per worker and
remembered in a table of bounded size. Decoding maps ids back to bytes.

The greedy merges of the model are the lowest-rank-first merges of the rank
file. A pre-token that is itself a vocabulary entry gets that entry's id.

Defined results: null and empty texts have no tokens, empty ids and empty
bytes. Any text round-trips, control characters included.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusgraph.llm.common import BINARY, LONG, STRING, annotate, record

RESULT = record(n_tokens=LONG, ids=STRING, decoded=BINARY)

#: Pre-tokens remembered by one worker; a full table is emptied.
REMEMBERED = 300_000

_NORMAL, _UNKNOWN, _BPE = 1, 2, 2


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def byte_letters() -> list[str]:
    """A printable character for each byte: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _nested(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _piece(text: str, score: float, kind: int) -> bytes:
    return _nested(1, _nested(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def serialise(ranks: dict[bytes, int]) -> tuple[bytes, list[int]]:
    """Model bytes, and the rank that each of its piece numbers stands for."""
    letters = byte_letters()
    order = sorted(ranks.items(), key=lambda x: x[1])
    body = [_piece("<unk>", 0.0, _UNKNOWN)]
    body += [_piece("".join(letters[b] for b in token), -float(rank), _NORMAL) for token, rank in order]
    body.append(_nested(2, _number(3, _BPE) + _number(4, len(order) + 1)))
    body.append(_nested(3, _nested(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)))
    return b"".join(body), [-1, *[rank for _, rank in order]]


class _Known(dict):
    """Ids of pre-tokens as text; one that is not there yet is encoded."""

    def __init__(self, ranks: dict[bytes, int]):
        import sentencepiece

        model, rank_of = serialise(ranks)
        self.encode = sentencepiece.SentencePieceProcessor(model_proto=model).EncodeAsIds
        self.text = [str(r) for r in rank_of]
        self.letters = dict(enumerate(byte_letters()))
        self.own = {t.decode(): str(r) for t, r in ranks.items() if _is_text(t)}

    def __missing__(self, token: str) -> str:
        ids = self.own.get(token)
        if ids is None:
            pieces = self.encode(token.encode().decode("latin-1").translate(self.letters))
            ids = " ".join([self.text[p] for p in pieces])
        self[token] = ids
        return ids


class Tokenizer:
    """Encoder and decoder of one worker."""

    def __init__(self, path: str, pattern: str):
        import regex

        ranks = load_ranks(path)
        self.known = _Known(ranks)
        self.bytes_of = {str(r): t for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall

    def encode(self, text: str) -> str:
        """Ids as decimal numbers with one space between."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return " ".join(map(self.known.__getitem__, self.split(text)))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def _worker(path: str, pattern: str) -> Callable[[pa.Array], pa.Array]:
    tokenizer = Tokenizer(path, pattern)

    def work(texts: pa.Array) -> pa.Array:
        ids = [tokenizer.encode(t) if t else "" for t in texts.to_pylist()]
        counts = [i.count(" ") + 1 if i else 0 for i in ids]
        decoded = [tokenizer.decode(i) for i in ids]
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.binary())], names=["n_tokens", "ids", "decoded"]
        )

    return work


def encode_decode(
    docs: DataFrame, path: str, pattern: str, *, text: str = "text", into: str = "tokens", keep: list[str] | None = None
) -> DataFrame:
    """Documents with a struct `into`: n_tokens, ids (decimal, one space between), decoded (bytes of these ids).

    `path` is a rank file that every executor can open, `pattern` cuts texts into pre-tokens.
    """
    return annotate(docs, text, lambda: _worker(path, pattern), RESULT, into, keep)
