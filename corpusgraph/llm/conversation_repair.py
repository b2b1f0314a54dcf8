"""Repair of conversation structure at least cost, streamed in turn order.

A repaired conversation has the roles `(s?(ua)+)?`: perhaps a system turn, then
user and assistant in turns, or nothing at all. Rows may be kept, given the
role user or assistant, or deleted, and empty turns may be inserted. Rows are
dealt out by conversation and sorted by turn; a dynamic program over the four
states of that pattern (nothing yet, after system, after user, after assistant)
then reads them once, in `mapInPandas`, and lives on from one Arrow batch to
the next. It carries, per state, the cost, the rank of its edits among those of
the other states, and the running digest of the repaired text, so texts are
never held. Four bytes per row of back-pointers lead to the edits; those of
giant conversations are spilled to a scratch file that is gone with the task.

Ties go to the edits whose initials, in order, are least in ASCII. Two states'
edits after a row differ before either ends (each has one letter per row, and a
letter of a row is no insertion), so a rank of four decides, whatever follows.

A conversation is one digest and one string of edits by definition, so its rows
meet in one task; that task's memory is one letter per row. All that needs no
order across conversations is done before, row by row or by Spark's own sort.

Defined results: a null role or text is one space; a null turn sorts first and
is left out of gaps; rows of one turn sort by role and text; a null id is one
conversation; a role whose first letter is not s, u or a, or that is empty, can
only be changed or deleted; a conversation of which no row is left has zeros,
no edits and the digest of nothing; no rows, no conversations.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusgraph.llm.common import LONG, STRING, bounded_batches, record

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Cost of each edit, and of a truncated row that is not deleted.
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

#: States by the last role so far: none, system, user, assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant turn must lead to, and its role.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Insertions at the end that complete the pattern.
CLOSING = (0, 2, 1, 0)
LEGAL = ("su", "ua", "au")

#: Bytes of back-pointers held in memory.
SPILL_BYTES = 1 << 20


def damaged(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", period: int = 20
) -> DataFrame:
    """Rows with faults put in by a hash of conversation and turn; column `dropped` marks those taken out."""
    space = F.lit(" ")
    own = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"),
    )
    key = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    own = own.withColumn("kind", F.crc32(key) % period)
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    said = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return own.select("conv", "turn", said.alias("role"), body.alias("text"), (F.col("kind") == 0).alias("dropped"), copies.alias("copy")).drop("copy")


def plain(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as `repair` reads them, nothing taken out."""
    space = F.lit(" ")
    return rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"), F.lit(False).alias("dropped"),
    )


def _last(text: Column) -> Column:
    """The last character that is not blank, empty if there is none."""
    return F.substring(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1)


@cache
def steps(initial: str, fault: int) -> tuple[tuple[int, int, int, str, int], ...]:
    """Ways through one row: from state, insertions before, edit's cost with them, letters, to state."""
    out = []
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for state in range(4):
        at, before = state, ""
        for inserted in range(3):
            cost = inserted * COST[INSERT]
            if inserted == 0:
                # A deletion after insertions costs as much as before them, and its letter is the smaller one.
                out.append((state, inserted, COST[DELETE], before + DELETE, at))
            if fault not in (BLANK, DUPLICATE):
                if initial == "s" and at == NONE:
                    out.append((state, inserted, cost + COST[KEEP] + extra, before + KEEP, SYSTEM))
                if initial == ROLES[FOLLOWS[at]][0]:
                    out.append((state, inserted, cost + COST[KEEP] + extra, before + KEEP, FOLLOWS[at]))
                out.append((state, inserted, cost + COST[REROLE] + extra, before + REROLE, FOLLOWS[at]))
            at, before = FOLLOWS[at], before + INSERT
    return tuple(out)


def _insert(digest: hashlib._Hash, state: int, count: int) -> int:
    for _ in range(count):
        digest.update(b"\n" if state != NONE else b"")
        state = FOLLOWS[state]
        digest.update(f"{ROLES[state]}:".encode())
    return state


class Repair:
    """The dynamic program over one conversation, one row after the other."""

    def __init__(self, spill_bytes: int = SPILL_BYTES) -> None:
        #: Per state that can be reached: cost, rank of its edits, digest of the repaired text so far.
        self.live = {NONE: (0, 0, hashlib.sha256())}
        self.pointers = bytearray()
        self.spill_bytes = spill_bytes
        self.file = None
        self.rows = 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.low = self.high = self.last_turn = None
        self.before: tuple[str, str] | None = None
        self.last: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, fault: int, repeats: bool) -> None:
        """`fault` is that of the row itself; `repeats` says that an earlier turn had the same role and text."""
        self.rows += 1
        if fault != BLANK and (repeats or self.last == (turn, role, text)):
            fault = DUPLICATE
        self.last = (turn, role, text)
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == TRUNCATED
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last_turn:
            self.low = turn if self.low is None else self.low
            self.high, self.last_turn = turn, turn
            self.turns += 1
        best: dict[int, tuple] = {}
        for step in steps(initial, fault):
            source = self.live.get(step[0])
            if source is not None:
                key = (source[0] + step[2], source[1], step[3])
                if step[4] not in best or key < best[step[4]][0]:
                    best[step[4]] = (key, step)
        ranks = {state: rank for rank, state in enumerate(sorted(best, key=lambda s: best[s][0][1:]))}
        live = {}
        pointer = [0, 0, 0, 0]
        body = None
        for state, (key, (source, inserted, _, letters, _)) in best.items():
            digest = self.live[source][2].copy()
            at = _insert(digest, source, inserted)
            edit = letters[-1]
            if edit != DELETE:
                body = body or f":{text}".encode("utf-8", "surrogatepass")
                digest.update(b"\n" if at != NONE else b"")
                digest.update((ROLES[state] if edit == REROLE else role).encode())
                digest.update(body)
            live[state] = (key[0], ranks[state], digest)
            pointer[state] = source | inserted << 2 | "KRD".index(edit) << 4
        self.live = live
        self.pointers += bytes(pointer)
        if len(self.pointers) >= self.spill_bytes:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.pointers)
            self.pointers.clear()

    def _blocks(self) -> Iterator[bytes]:
        """Back-pointers from the last to the first, a block at a time."""
        yield bytes(self.pointers)
        if self.file is not None:
            at = self.file.tell()
            while at > 0:
                size = min(at, self.spill_bytes - self.spill_bytes % 4)
                at -= size
                self.file.seek(at)
                yield self.file.read(size)
            self.file.close()

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        ends = []
        for state, (cost, rank, digest) in self.live.items():
            closing = CLOSING[state]
            ends.append((cost + closing * COST[INSERT], rank, state, closing, digest))
        cost, _, state, closing, digest = min(ends, key=lambda e: e[:2])
        final = digest.copy()
        _insert(final, state, closing)
        letters = bytearray(INSERT * closing, "ascii")
        for block in self._blocks():
            for i in range(len(block) - 4, -1, -4):
                pointer = block[i + state]
                letters += b"KRD"[pointer >> 4 : (pointer >> 4) + 1] + b"I" * (pointer >> 2 & 3)
                state = pointer & 3
        letters.reverse()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, letters.decode(), final.hexdigest()


_RESULT = record(gaps=LONG, blank=LONG, duplicate=LONG, truncated=LONG, illegal=LONG, cost=LONG, audit=STRING, repaired_sha256=STRING)


def repair(rows: DataFrame, *, conv: str = "conv_id", spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conversation of `damaged` or `plain` rows: its faults and the cheapest edits that repair it.

    gaps counts the missing turn numbers; blank, duplicate and truncated the rows by their first fault; illegal the
    neighbours whose roles' first letters do not follow each other; audit has one letter per edit (Keep, Rerole,
    Delete, Insert), repaired_sha256 is the digest of the repaired `role:text` rows, newline between.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    last = _last(F.col("text"))
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    # Both sorts use the one exchange by conversation.
    placed = rows.withColumn("fault", fault).withColumn("said", said).repartition("conv")
    same = W.partitionBy("conv", "said").orderBy(F.col("dropped"), F.col("turn").asc_nulls_first())
    first = F.first(F.struct("turn")).over(same.rowsBetween(W.unboundedPreceding, 0))
    placed = placed.withColumn("repeats", ~F.col("turn").eqNullSafe(first["turn"]))
    order = ["conv", "dropped", F.col("turn").asc_nulls_first(), "role", "text"]
    kind = rows.schema["conv"].dataType
    source = placed.sortWithinPartitions(*order).select(
        F.col("conv").isNull().alias("unnamed"), F.col("conv").cast("string").alias("key"), F.col("turn").isNull().alias("untimed"),
        F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "fault", "repeats", "dropped",
    )
    schema = T.StructType([*record(key=STRING), *_RESULT])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: tuple | None = None
        state = Repair(spill_bytes)
        done: list[tuple] = []
        for batch in batches:
            for unnamed, key, untimed, turn, role, text, own, repeats, dropped in zip(*[batch[c].tolist() for c in batch.columns], strict=True):
                name = (unnamed, None if unnamed else key)
                if name != current:
                    if current is not None:
                        done.append((current[1], *state.result()))
                    current, state = name, Repair(spill_bytes)
                if not dropped:
                    state.add(None if untimed else turn, role, text, own, repeats)
            if done:
                yield pd.DataFrame(done, columns=schema.names)
                done = []
        if current is not None:
            yield pd.DataFrame([(current[1], *state.result())], columns=schema.names)

    found = source.mapInPandas(run, schema)
    return found.select(F.col("key").cast(kind).alias(conv), *_RESULT.names)
