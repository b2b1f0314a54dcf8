"""Text expressions: names, spans, folding, slugs, classification."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks as the ECMAScript standard lists them.
BLANKS = r"\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
# The same class, written so that an ASCII character is settled by two tests and not by one for each of its parts.
WS = rf"[\s[\u00a0-\ufeff&&[{BLANKS}]]]"
_BLANK = re.compile(f"[{BLANKS}]")
# What squeezing changes: a run of blanks, or one that is no space.
UNEVEN = rf"{WS}{{2,}}|[\s[\u00a0-\ufeff&&[{BLANKS}]]&&[^ ]]"
BLANK_CHARS = "".join(c for c in map(chr, range(0x10000)) if _BLANK.match(c))
# ASCII word boundary, the same on every Java version.
EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"

# Letters whose canonical decomposition is a base letter plus marks.
_FOLDED = [
    (chr(cp), base)
    for low, high in ((0x00C0, 0x0530), (0x1E00, 0x2000))
    for cp in range(low, high)
    for base in [unicodedata.normalize("NFD", chr(cp))[0]]
    if base != chr(cp)
]
_FROM = "".join(a for a, _ in _FOLDED)
_TO = "".join(b for _, b in _FOLDED)


def trim_blanks(col: Column) -> Column:
    """Without blanks of any kind at either end; line ends and no-break spaces count.

    A pattern for the end of a text would be tried at every blank of every run; this reads each end once.
    """
    return F.btrim(col, F.lit(BLANK_CHARS))


def squeeze(col: Column) -> Column:
    """Runs of blanks become one space, ends trimmed."""
    return F.trim(F.regexp_replace(col, UNEVEN, " "))


def last_word(col: Column) -> Column:
    """What follows the last blank."""
    return F.substring_index(F.translate(col, BLANK_CHARS, " " * len(BLANK_CHARS)), " ", -1)


def fold(col: Column) -> Column:
    """Lower case without accents."""
    plain = F.octet_length(col) == F.length(col)
    bare = F.translate(F.lower(col), _FROM, _TO)
    return F.when(plain, F.lower(col)).otherwise(F.regexp_replace(bare, r"[\u0300-\u036f]", ""))


def contains_ai(text: Column, part: Column) -> Column:
    return F.contains(fold(text), fold(part))


def safe_name(col: Column, limit: int = 110) -> Column:
    """Name usable as a file name and as a link target."""
    named = F.coalesce(F.nullif(col, F.lit("")), F.lit("Untitled"))
    bare = squeeze(F.regexp_replace(named, r'[\\/:*?"<>|#^\[\]]', " "))
    return F.regexp_replace(F.substring(bare, 1, limit), r"[ .]+$", "")


def date_only(iso: Column) -> Column:
    return F.coalesce(F.substring(iso, 1, 10), F.lit(""))


def span(first: Column, last: Column) -> Column:
    """`2019`, `2019–2021`, or empty when an end is unknown."""
    a, b = F.substring(first, 1, 4), F.substring(last, 1, 4)
    known = (F.coalesce(first, F.lit("")) != "") & (F.coalesce(last, F.lit("")) != "")
    return F.when(~known, "").when(a == b, a).otherwise(F.concat(a, F.lit("–"), b))


# Path segments that are listings, not articles.
LISTING_SEGMENTS = ("category", "tag", "author", "page")


def internal_slug(url: Column, hosts: Sequence[str], base_host: str | None = None) -> Column:
    """Article slug of a link into one of `hosts`, else null.

    Links without a host count as pointing at `base_host`.
    """
    host = F.lower(F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1), "^www\\.", ""))
    relative = ~url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") & ~url.startswith("//")
    host = F.when(relative, F.lit(base_host or hosts[0])).otherwise(host)
    path = F.regexp_extract(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"^([^?#]*)", 1)
    segment = F.btrim(path, F.lit("/"))
    good = (
        host.isin([h.lower() for h in hosts])
        & (segment != "")
        & ~F.contains(segment, F.lit("/"))
        & ~segment.isin(*LISTING_SEGMENTS)
    )
    return F.when(good, segment)


# Content types in order of precedence, with tier and folder.
CONTENT_TYPES = (
    ("Satire", "not-factual", "Satire"),
    ("Primary-Document", "primary", "Documents"),
    ("Investigation", "high", "Investigations"),
    ("Guest-View", "opinion", "Guest-Views"),
    ("Opinion", "opinion", "Opinion"),
    ("Reporting", "medium", "Reporting"),
)
SATIRE_TITLE = rf"(?i){EDGE}(satire|fiction|parody){EDGE}"
OPINION_TITLE = rf"(?i)^{WS}*(opinion|editorial|commentary){EDGE}"


def content_type(title: Column, category_types: Column) -> Column:
    """Highest-precedence type among the categories' types and the title rules."""
    title = F.coalesce(title, F.lit(""))
    types = F.coalesce(category_types, F.array().cast("array<string>"))
    rule = {"Satire": title.rlike(SATIRE_TITLE), "Opinion": title.rlike(OPINION_TITLE)}
    chosen = F
    for name, _, _ in CONTENT_TYPES[:-1]:
        hit = F.array_contains(types, name) | rule.get(name, F.lit(False))
        chosen = chosen.when(hit, name)
    return chosen.otherwise(CONTENT_TYPES[-1][0])


def content_tier(kind: Column) -> Column:
    tiers = F.create_map(*[F.lit(v) for n, t, _ in CONTENT_TYPES for v in (n, t)])
    return F.coalesce(F.try_element_at(tiers, kind), F.lit("medium"))


def content_folder(kind: Column) -> Column:
    folders = F.create_map(*[F.lit(v) for n, _, f in CONTENT_TYPES for v in (n, f)])
    return F.coalesce(F.try_element_at(folders, kind), F.lit("Reporting"))


def quoted(words: Sequence[str]) -> str:
    """Alternation of literal words, longest first."""
    return "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))
