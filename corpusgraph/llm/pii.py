"""Personal data in texts.

Patterns propose spans, validators confirm them (Luhn for cards, mod 97 for
IBANs, ranges for addresses and numbers), and words nearby raise or lower the
score. The four base kinds are listed by pattern and validator alone, whatever
their score; the further kinds need a score of `threshold` and never overlap a
base span. Only spans that reach `threshold` are masked, so a version number in
the form of an address is listed and stays in the text.

Offsets are code points, end exclusive. Defined results: null and empty texts
have no spans; documents are judged one by one, so repeated rows repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.llm.common import BOOL, DOUBLE, STRING, annotate, record

#: Order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE = KINDS[:4]

SPAN = record(kind=STRING, start=T.IntegerType(), end=T.IntegerType(), base=BOOL, score=DOUBLE)
RESULT = record(spans=T.ArrayType(SPAN), masked=STRING)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs and the look-behind only spare tries that cannot succeed in one long run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
# Letters and digits of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_KEY = re.compile(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])")
# An underscore or hyphen may stand before the key's last word, as in client_secret.
_ASSIGNED = re.compile(r"(?<![A-Za-z0-9])(?:password|passwd|secret|token|(?:api|private|access|secret)[_-]?key)\b[\x20\"']{0,3}[=:][\x20\"']{0,3}([^\s\"']{8,})", re.I)
_CAMEL = re.compile("[a-z][A-Z]")
#: The case-folded text of every match holds one of these; folding takes the long s and the Kelvin sign to s and k, as re.I does.
_ASSIGN_WORDS = ("pass", "secret", "token", "key")

#: What pattern and validator of a base kind are worth by themselves.
WORTH = {"email": 1.0, "ip": 0.7, "card": 0.9, "phone": 0.9}
#: Words that raise a kind's score when they stand within 40 characters before it.
CONTEXT = {
    "email": (),
    "ip": ("ip", "address", "server", "host", "client"),
    "card": ("card", "visa", "payment", "credit"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "ssn": ("ssn", "social", "security", "tax"),
    "secret": ("key", "aws", "secret", "password", "token", "access"),
}
#: Words that lower it.
AGAINST = ("order", "invoice", "version", "isbn", "serial")
NEARBY = 40


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join([str(int(c, 36)) for c in moved])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain: the run before each @ is walked once."""
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        at = text.find("@", max(at + 1, floor))


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    for start, end in emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", *m.span()


@cache
def _rest(n: int) -> re.Pattern:
    return re.compile(rf"(?:\x20?[A-Z0-9]){{{n}}}(?![A-Za-z0-9])")


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Bank numbers of their country's length; of a country not known here, any length that ends a word."""
    for m in _IBAN.finditer(text):
        own = IBAN_LENGTHS.get(m[0][:2])
        for n in (own - 4,) if own else range(30, 10, -1):
            tail = _rest(n).match(text, m.end())
            if tail and mod97(text[m.start() : tail.end()].replace(" ", "")):
                yield m.start(), tail.end()
                break


def _more(text: str) -> Iterator[tuple[str, int, int, float]]:
    """Kind, start, end, and the score that pattern and checksum give by themselves."""
    for start, end in ibans(text):
        yield "iban", start, end, 0.8
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span(), 0.4
    if "AKIA" in text:
        for m in _KEY.finditer(text):
            yield "secret", *m.span(), 0.8
    folded = text.casefold() if "=" in text or ":" in text else ""
    if any(w in folded for w in _ASSIGN_WORDS):
        for m in _ASSIGNED.finditer(text):
            # A digit, or capitals inside, part a secret from a word.
            if any(map(str.isdigit, m[1])) or _CAMEL.search(m[1]):
                yield "secret", *m.span(1), 0.6


def find(text: str, threshold: float = 0.5) -> list[tuple[str, int, int, bool, float]]:
    """Spans of one text in order of start, then kind."""
    def weighed(kind: str, start: int, score: float) -> float:
        before = text[max(0, start - NEARBY) : start].lower()
        return score + 0.2 * any(w in before for w in CONTEXT[kind]) - 0.3 * any(w in before for w in AGAINST)

    out = [(kind, start, end, True, round(min(weighed(kind, start, WORTH[kind]), 1.0), 2)) for kind, start, end in _base(text)]
    base = sorted((start, end) for _, start, end, _, _ in out)
    furthest = list(accumulate((end for _, end in base), max))
    more: list[tuple[int, int]] = []  # never overlap one another
    for kind, start, end, score in _more(text):
        score = weighed(kind, start, score)
        at = bisect_left(base, (end,))
        place = bisect_left(more, (end,))
        taken = (at and furthest[at - 1] > start) or (place and more[place - 1][1] > start)
        if score >= threshold and not taken:
            out.append((kind, start, end, False, round(min(score, 1.0), 2)))
            more.insert(place, (start, end))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def mask(text: str, spans: list[tuple[str, int, int, bool, float]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by [KIND] of its first."""
    parts, done = [], 0
    for kind, start, end, _, _ in spans:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def _worker(threshold: float, masked: bool) -> Callable[[pa.Array], pa.Array]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))

    def work(texts: pa.Array) -> pa.Array:
        plain = texts.to_pylist()
        spans = [find(t, threshold) if t else [] for t in plain]
        rows = [[dict(zip(("kind", "start", "end", "base", "score"), s, strict=True)) for s in own] for own in spans]
        clean = [mask(t, [x for x in s if x[4] >= threshold]) if s else t for t, s in zip(plain, spans, strict=True)] if masked else [None] * len(plain)
        return pa.StructArray.from_arrays([pa.array(rows, kind), pa.array(clean, pa.string())], names=["spans", "masked"])

    return work


def find_personal_data(
    docs: DataFrame, *, text: str = "text", threshold: float = 0.5, masked: bool = False, into: str = "pii", keep: list[str] | None = None
) -> DataFrame:
    """Documents with a struct `into`: spans (kind, start, end, base, score), and with `masked` the text without those that reach `threshold`."""
    return annotate(docs, text, lambda: _worker(threshold, masked), RESULT, into, keep)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
