"""Chat formatting from a declarative template, in DataFrame functions only.

A finite-state machine over roles says whether the turns of a conversation
come in a valid order. Every turn becomes three segments, marker, text and
marker, each with a loss flag; the segments in order are the training text.
Inside texts and role names the first characters of markers are replaced by
entities, so no text can forge a marker, and `read_back` undoes it exactly.

A conversation is one value by definition, so its rows meet in one row; texts
are escaped before that. Defined results: a null text or role is empty; rows
sort by turn (null first), ties by role and text, so repeated rows repeat; a
null conversation id is one conversation; invalid orders are formatted and
flagged; no rows give no conversations.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers and loss per role, the order that roles may take, and the entities of characters that begin markers."""

    turns: Mapping[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Turn("[INST] ", " [/INST]\n"),
        "assistant": Turn("<s>", "</s>\n", loss=True),
    })
    #: Around a role that has no markers of its own: before + role + between, after.
    other: tuple[str, str, str] = ("<|", "|>\n", "<|end|>\n")
    next_roles: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)
    #: In this order; the escape character itself comes first.
    entities: tuple[tuple[str, str], ...] = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("|", "&vert;"))

    def __post_init__(self) -> None:
        first = {c for c, _ in self.entities}
        markers = [m for t in self.turns.values() for m in (t.before, t.after.strip())] + [self.other[0], self.other[2]]
        if not all(m and m[0] in first for m in markers):
            raise ValueError("every marker must begin with a character that has an entity")


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    for char, entity in template.entities:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    for char, entity in reversed(template.entities):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _by_role(role: Column, template: Template, pick, other: Column) -> Column:
    out = None
    for name, turn in template.turns.items():
        out = F.when(role == name, pick(turn)) if out is None else out.when(role == name, pick(turn))
    return other if out is None else out.otherwise(other)


def format_conversations(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: Template = DEFAULT
) -> DataFrame:
    """conv, n_turns, valid (order of roles), segments (text, loss), formatted; other columns are not used."""
    name = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    turns = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("at"), name.alias("role"), body.alias("raw"))
    head, mid, tail = template.other
    before = _by_role(F.col("role"), template, lambda t: F.lit(t.before), F.concat(F.lit(head), escape(F.col("role"), template), F.lit(mid)))
    after = _by_role(F.col("role"), template, lambda t: F.lit(t.after), F.lit(tail))
    loss = _by_role(F.col("role"), template, lambda t: F.lit(t.loss), F.lit(False))
    segments = F.array(
        F.struct(before.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(F.col("raw"), template).alias("text"), loss.alias("loss")),
        F.struct(after.alias("text"), F.lit(False).alias("loss")),
    )
    made = turns.select("conv", F.struct("at", "role", "raw", segments.alias("segments")).alias("turn"))
    whole = made.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    moves = {f"{state}>{r}": r for state, follow in template.next_roles.items() for r in follow}
    table = F.create_map(*[F.lit(x) for pair in moves.items() for x in pair])
    state = F.aggregate(
        F.transform("turns", lambda t: t["role"]), F.lit(""),
        lambda at, r: F.coalesce(F.try_element_at(table, F.concat(at, F.lit(">"), r)), F.lit("!")),
    )
    segments = F.flatten(F.transform("turns", lambda t: t["segments"]))
    out = whole.select("conv", F.size("turns").cast("long").alias("n_turns"), state.isin(*template.final).alias("valid"), segments.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """Turns (role, text, loss) as an array, parsed from a formatted conversation alone."""
    plain = "[^" + "".join(re.escape(c) for c, _ in template.entities if c != "&") + "]*"
    head, mid, tail = template.other
    pieces = [re.escape(t.before) + plain + re.escape(t.after) for t in template.turns.values()]
    pieces.append(re.escape(head) + plain + re.escape(mid) + plain + re.escape(tail))
    found = F.regexp_extract_all(formatted, F.lit("|".join(pieces)), F.lit(0))

    def parse(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(head) + 1), F.length(piece) - len(head) - len(tail))
        cut = F.instr(inner, mid)
        role = unescape(F.substring(inner, F.lit(1), cut - 1), template)
        text = F.substring(inner, cut + len(mid), F.length(inner))
        loss = F.lit(False)
        for name, t in template.turns.items():
            own = piece.startswith(t.before)
            role = F.when(own, name).otherwise(role)
            text = F.when(own, F.substring(piece, F.lit(len(t.before) + 1), F.length(piece) - len(t.before) - len(t.after))).otherwise(text)
            loss = F.when(own, F.lit(t.loss)).otherwise(loss)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"), loss.alias("loss"))

    return F.transform(found, parse)
