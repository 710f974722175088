"""Repair of a conversation's structure as a lightest derivation.

A well-formed conversation's role initials match ``(s?(ua)+)?``: an optional
system row, then user and assistant in turn.  A conversation is repaired by
edits of its rows in order; the cheapest sequence wins, the ASCII-least edit
initials among those of equal cost:

=======  ====  ==========================================================
edit     cost  
=======  ====  ==========================================================
Keep     0     plus 1 if the row is truncated; not for blank or duplicate
Rerole   2     to user or assistant; as Keep otherwise
Delete   3
Insert   2     an empty user or assistant row, anywhere
=======  ====  ==========================================================

The search is a deduction over a weighted hypergraph.  An item ``(i, q)``
stands for the lightest repair of the rows from ``i`` on that takes the
grammar's automaton from state ``q`` to an accepting one.  An edit is an axiom
with a cost and an initial, and a rule joins it with an item:

    edit of row i, reading r     (i + 1, step(q, r))
    ------------------------------------------------   and for Insert (i, step(q, r)) => (i, q)
                         (i, q)

A rule adds the costs and puts the initial *before* the item's initials, which
keeps the order of any two weights (putting it behind would not: ``D < DI``
but ``DK > DIK``).  Items leave the agenda by (cost, rows read, initials).
Every rule raises the cost or reads a row, so a conclusion comes after its
premises, and an item is final when it is popped: the goal ``(0, start)`` ends
the search.  Initials are linked cells that share their tails, so memory grows
with the rows, not with their square.

Each task sorts its rows by conversation and turn and holds one conversation
at a time; like its repaired form, that is one value, so a conversation must
fit in a task's memory.  Conversations never meet in one group.

Odd rows: null roles, texts and turns count as one space wherever they are
read as text; null turns stand first; rows of equal turn are taken by role,
then text; rows of a null conv_id are one conversation.  A role that is empty
or starts with another letter is never legal.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import emit

ROLES = {"u": "user", "a": "assistant"}
# States of the grammar: 0 start, 1 after s, 2 after u, 3 after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
BEFORE = {r: [(p, q) for (p, c), q in STEP.items() if c == r] for r in "sua"}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows: list[tuple[str, str]]) -> list[str]:
    """Each row's first fault: ``blank``, ``duplicate``, ``truncated`` or ``''``."""
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(SPACE)
        if not end:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def less(a, b) -> bool:
    """Whether initials ``a`` come before ``b``; both are cells
    ``(initial, role, tail)`` or None at the end."""
    while a is not b:
        if a is None or b is None:
            return a is None
        if a[0] != b[0]:
            return a[0] < b[0]
        a, b = a[2], b[2]
    return False


def lightest(initials: list[str], faults: list[str]) -> tuple[int, list[tuple[str, str | None]]]:
    """Cost and edits ``(initial, role)`` of the lightest repair."""
    n = len(initials)
    best: dict[tuple[int, int], tuple[int, tuple | None]] = {}
    final: set[tuple[int, int]] = set()
    agenda: list[tuple[int, int, int]] = []

    def conclude(i: int, q: int, cost: int, cell) -> None:
        known = best.get((i, q))
        if known is None or cost < known[0] or cost == known[0] and less(cell, known[1]):
            best[i, q] = cost, cell
            if known is None or cost < known[0]:
                heappush(agenda, (cost, n - i, q))

    for q in FINAL:
        conclude(n, q, 0, None)
    while agenda:
        cost, read, q = heappop(agenda)
        i = n - read
        if (i, q) in final:
            continue
        final.add((i, q))
        cell = best[i, q][1]
        if (i, q) == (0, 0):
            break
        for r in ROLES:
            for p, to in BEFORE[r]:
                if to == q:
                    conclude(i, p, cost + 2, ("I", r, cell))
        if not i:
            continue
        conclude(i - 1, q, cost + 3, ("D", None, cell))
        if faults[i - 1] in ("blank", "duplicate"):
            continue
        extra = faults[i - 1] == "truncated"
        for r in "sua":
            for p, to in BEFORE[r]:
                if to == q:
                    if initials[i - 1] == r:
                        conclude(i - 1, p, cost + extra, ("K", None, cell))
                    if r in ROLES:
                        conclude(i - 1, p, cost + 2 + extra, ("R", r, cell))
    edits, (cost, cell) = [], best[0, 0]
    while cell is not None:
        edits.append(cell[:2])
        cell = cell[2]
    return cost, edits


def apply_edits(rows: list[tuple[str, str]], edits: list[tuple[str, str | None]]) -> list[tuple[str, str]]:
    out, given = [], iter(rows)
    for edit, r in edits:
        role, text = ("", "") if edit == "I" else next(given)
        if edit != "D":
            out.append((ROLES[r] if r else role, text))
    return out


REPAIRED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired array<struct<role:string,text:string>>")
_REPAIRED = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated",
                                                                           "illegal", "cost")),
                       ("audit", pa.string()),
                       ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def repair_one(rows: list[tuple[int | None, str, str]]) -> tuple:
    """All columns but the id, of one conversation's ``(turn, role, text)`` in order."""
    turns = {t for t, _, _ in rows if t is not None}
    said = [(role, text) for _, role, text in rows]
    initials, faults = [role[:1] for role, _ in said], faults_of(said)
    cost, edits = lightest(initials, faults)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            cost, "".join(e for e, _ in edits),
            [{"role": r, "text": t} for r, t in apply_edits(said, edits)])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv_id, group in groupby(_rows(batches), key=lambda r: r[0]):
            said = [r[1:4] for r in group if r[4]]
            yield (conv_id, *repair_one(said)), 128 + sum(len(t) + len(r) for _, r, t in said)

    return emit(_REPAIRED, rows())


def repair(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """Repairs every conversation of ``rows`` (``conv_id long, turn long, role
    string, text string``): counts of its faults, the cost, the edits'
    initials (``audit``) and the ``repaired`` rows.  A row that is not
    ``present`` only makes its conversation known; one without rows is empty."""
    blank = F.lit(" ")
    given = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                        (F.lit(True) if present is None else present).alias("present"))
    return (given.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_repaired, REPAIRED))


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present`` damaged by crc32 of
    ``conv_id:turn`` modulo 20: 0 drops the row (``present`` is false), 1
    empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it
    the user's."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    told = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                       kind.alias("_kind"))
    damaged = told.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("_kind") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_copy"))
    return damaged.drop("_copy")


def repair_digest(rows: DataFrame) -> DataFrame:
    """The damaged rows repaired; the repaired ``role:text`` lines as a hash."""
    fixed = repair(damage(rows), F.col("present"))
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    return fixed.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("repaired")
