"""Conversation structure repair as a lightest derivation, found by Knuth's agenda.

An item says: the first ``at`` rows of a stretch are edited and the kept roles stand in ``state``.  Deductions
keep, re-role or delete the next row, or insert an empty one; a weight is (cost, rows read, audit).  Every
deduction is a superior function of its antecedent: it never lowers the cost, and if the cost stays it has
read a row more.  It is monotone too: two audits of one item with equal cost are never each other's prefix,
since the same rows are read and every further letter is an insertion, which costs.  So the agenda pops each
item once, with its final weight, and stops at the goal.

Long conversations are cut into stretches.  The items of a stretch, one for each pair of entry and exit
state, are derived in parallel; a deduction with two antecedents joins what stands before to a stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
#: Nothing kept yet, after the system row, after a user row, after an assistant row.
STATES = "SPUA"
GOALS = "SA"
_KEPT = {"Ss": "P", "Su": "U", "Pu": "U", "Ua": "A", "Au": "U"}
#: The state behind a row that an edit gives the role that fits.
_NEXT = {"S": "U", "P": "U", "U": "A", "A": "U"}
_ROLE = {"U": "user", "A": "assistant"}
#: A stretch ends at so many rows or characters.
STRETCH_ROWS, STRETCH_CHARS = 256, 1 << 21
_SPACE = " \t\n\v\f\r"
_FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


@lru_cache(maxsize=1 << 15)
def lightest(code: str, start: str = "S", goals: str = "") -> dict[str, tuple[int, str]]:
    """State after all rows -> (cost, audit) of its lightest derivation from ``start``.

    A row's letter in ``code`` is its role's initial (o: any but s, u and a), upper case if the text is
    truncated, or x if it must be deleted.  With ``goals`` the agenda stops at the first of them that it
    pops, and only that one is returned.
    """
    n, final = len(code), {}
    agenda = [(0, 0, "", start)]
    while agenda:
        cost, at, audit, state = heappop(agenda)
        if (at, state) in final:
            continue
        final[at, state] = cost, audit
        if at == n and state in goals:
            return {state: (cost, audit)}
        after = _NEXT[state]
        found = [(cost + INSERT, at, "I", after)]
        if at < n:
            found.append((cost + DELETE, at + 1, "D", state))
            role = code[at]
            if role != "x":
                late = CUT_OFF if role.isupper() else 0
                found.append((cost + REROLE + late, at + 1, "R", after))
                if kept := _KEPT.get(state + role.lower()):
                    found.append((cost + KEEP + late, at + 1, "K", kept))
        for c, a, edit, s in found:
            if (a, s) not in final:
                heappush(agenda, (c, a, audit + edit, s))
    return {s: final[n, s] for s in STATES if (n, s) in final}


def repaired(audit: str, state: str, rows) -> Iterator[bytes]:
    """The bytes of the repaired rows, each with the line feed that parts it from what stands before."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        after = _KEPT[state + role[:1]] if edit == "K" else _NEXT[state]
        role = role if edit == "K" else _ROLE[after]
        yield f"{'' if state == 'S' else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass")
        state = after


class Stretch:
    """Consecutive rows of one conversation, with the counts that can be added up."""

    def __init__(self):
        self.code, self.rows, self.chars = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.ends: list[str] = []   # initials of the first and the last row
        self.turns: list[int] = []  # number of different turns, the first and the last one

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        body = text.strip(_SPACE)
        if not body:
            self.blank += 1
            letter = "x"
        elif again:
            self.duplicate += 1
            letter = "x"
        else:
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if body[-1] not in ".!?":
                self.truncated += 1
                letter = letter.upper()
        self.code.append(letter)
        self.rows.append((role, text))
        self.chars += len(text)
        if self.ends:
            self.illegal += illegal(self.ends[1], role[:1])
        self.ends = [self.ends[0] if self.ends else role[:1], role[:1]]
        if turn is not None:
            _, first, last = self.turns or [0, turn, None]
            self.turns = [(self.turns or [0])[0] + (turn != last), first, turn]

    def full(self) -> bool:
        return len(self.rows) >= STRETCH_ROWS or self.chars >= STRETCH_CHARS


def illegal(before: str, after: str) -> int:
    return int(before + after not in ("su", "ua", "au"))


def gaps(turns: list[int]) -> int:
    return turns[2] - turns[1] + 1 - turns[0] if turns else 0


def whole(s: Stretch) -> tuple:
    """The results of a conversation that is one stretch."""
    (cost, audit), = lightest("".join(s.code), "S", GOALS).values()
    digest = hashlib.sha256(b"".join(repaired(audit, "S", s.rows))).hexdigest()
    return gaps(s.turns), s.blank, s.duplicate, s.truncated, s.illegal, cost, audit, digest


class Chain:
    """What stands before the next stretch: for each state its lightest (cost, audit) and the hash so far."""

    def __init__(self):
        self.live = {"S": (0, "", hashlib.sha256())}
        self.counts = [0, 0, 0, 0]
        self.last: str | None = None
        self.turns: list[int] = []

    def join(self, rows: list, spans: dict[tuple[str, str], tuple[int, str]], counts, ends: list[str], turns: list[int]) -> None:
        """The deduction of two antecedents: an item before the stretch and one of the stretch."""
        best: dict[str, tuple] = {}
        for (entry, leave), (cost, audit) in spans.items():
            if entry in self.live:
                before = self.live[entry]
                new = before[0] + cost, before[1] + audit, entry, audit
                if leave not in best or new[:2] < best[leave][:2]:
                    best[leave] = new
        live = {}
        for leave, (cost, audit, entry, piece) in best.items():
            digest = self.live[entry][2].copy()
            for raw in repaired(piece, entry, rows):
                digest.update(raw)
            live[leave] = cost, audit, digest
        self.live = live
        self.counts = [a + int(b) for a, b in zip(self.counts, counts)]
        if ends:
            if self.last is not None:
                self.counts[3] += illegal(self.last, ends[0])
            self.last = ends[1]
        if turns:
            n, first, last = self.turns or [0, turns[1], None]
            self.turns = [n + turns[0] - (turns[1] == last), first, turns[2]]

    def result(self) -> tuple:
        cost, audit, digest = min((self.live[s] for s in GOALS if s in self.live), key=lambda x: x[:2])
        return gaps(self.turns), *self.counts, cost, audit, digest.hexdigest()


_STRETCH = "part int, seq int, roles array<string>, texts array<string>, costs array<long>, audits array<string>, counts array<long>, ends array<string>, turns array<long>"
_PAIRS = [(p, q) for p in STATES for q in STATES]
_EMPTY = (None,) * 9


def _spans(code: str) -> tuple[list, list]:
    found = {p: lightest(code, p) for p in STATES}
    return ([found[p][q][0] if q in found[p] else None for p, q in _PAIRS],
            [found[p][q][1] if q in found[p] else None for p, q in _PAIRS])


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows -> results of conversations that lie whole in this partition and one stretch; else stretches."""
    names = ["conv", *(c.split()[0] for c in f"{_FACTS}, {_STRETCH}".split(", "))]
    part, seq, out = TaskContext.get().partitionId(), 0, []
    conv, s, opened, begun = None, None, True, False  # the first conversation may have begun elsewhere

    def stretch():
        nonlocal seq
        seq += 1
        costs, audits = _spans("".join(s.code))
        return (conv, *(None,) * 8, part, seq, [r for r, _ in s.rows], [t for _, t in s.rows], costs, audits,
                [s.blank, s.duplicate, s.truncated, s.illegal], s.ends, s.turns)

    for b in batches:
        for c, n, no_turn, turn, role, text, again in zip(b["conv"], b["n"], b["no_turn"], b["turn"], b["role"], b["text"],
                                                          b["again"]):
            if not begun or c != conv:
                if begun:
                    out.append(stretch() if opened else (conv, *whole(s), *_EMPTY))
                    opened = False
                conv, s, begun = c, Stretch(), True
            for copy in range(n):
                if s.full():
                    out.append(stretch())
                    opened, s = True, Stretch()
                s.add(None if no_turn else turn, role, text, again or copy > 0)
            if len(out) >= 512:
                yield pd.DataFrame(out, columns=names)
                out = []
    if begun:  # the last one may go on elsewhere
        out.append(stretch())
    if out:
        yield pd.DataFrame(out, columns=names)


def _join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stretches sorted by conversation, partition and number -> one result a conversation."""
    names = ["conv", *(c.split()[0] for c in _FACTS.split(", "))]
    conv, chain, out = None, None, []
    for b in batches:
        for c, roles, texts, costs, audits, counts, ends, turns in zip(
                b["conv"], b["roles"], b["texts"], b["costs"], b["audits"], b["counts"], b["ends"], b["turns"]):
            if chain is None or c != conv:
                if chain:
                    out.append((conv, *chain.result()))
                conv, chain = c, Chain()
            spans = {pair: (int(cost), audit) for pair, cost, audit in zip(_PAIRS, costs, audits) if audit is not None}
            chain.join(list(zip(roles, texts)), spans, counts, list(ends), [int(t) for t in turns])
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    if chain:
        yield pd.DataFrame([(conv, *chain.result())], columns=names)


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           copies: Column | None = None) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``copies`` says how often a row stands there (default once); a row with 0 copies only names its
    conversation, so a conversation without rows gets zeros, an empty audit and the empty string's hash.
    NULL roles and texts count as one space; NULL turns come first and a NULL id is a conversation of its
    own; rows of one turn stand in the order of the SHA-256 of role and text, so equal rows are
    neighbours.  Other columns are not read.  An empty table gives no rows.

    Rows are dealt by ranges of (conversation, turn), so a conversation of any size is spread, and repeated
    contents are found by an aggregate of digests.  Only the hash of a long conversation's repaired text
    goes through one task, in order and one stretch at a time, for such a hash can only be taken so.
    """
    conv = F.col(id_col)
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit(" ")), F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    base = rows.select(conv.alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       (F.lit(1) if copies is None else copies).cast("int").alias("n"))
    sig = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    base = checkpoint(base.select("conv", "turn", "role", "text", "n", sig.alias("sig"), F.monotonically_increasing_id().alias("row")),
                      "conversation-rows")
    seen = (base.where("n > 0").groupBy("conv", "sig")
            .agg(F.min(F.struct(F.col("turn").isNotNull().alias("timed"), "turn", "row"))["row"].alias("first"), F.count("*").alias("times"))
            .where("times > 1").select(F.col("conv").alias("c"), F.col("sig").alias("g"), "first"))
    facts = (base.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("sig") == F.col("g")), "left")
             .withColumn("again", F.coalesce(F.col("row") != F.col("first"), F.lit(False))))
    order = [F.col("conv"), F.col("turn"), F.col("sig"), F.col("row")]
    ordered = facts.repartitionByRange(*order).sortWithinPartitions(*order)
    # Ids pass as text: pandas would turn a column of longs with NULLs into doubles.
    told = checkpoint(ordered.select(F.col("conv").cast("string").alias("conv"), "n", F.col("turn").isNull().alias("no_turn"),
                                     F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "again")
                      .mapInPandas(_walk, f"conv string, {_FACTS}, {_STRETCH}"), "conversation-stretches")
    results = ["conv", *(c.split()[0] for c in _FACTS.split(", "))]
    chained = (told.where(F.col("seq").isNotNull()).drop(*results[1:]).repartition("conv")
               .sortWithinPartitions("conv", "part", "seq").mapInPandas(_join, f"conv string, {_FACTS}"))
    out = told.where(F.col("seq").isNull()).select(*results).unionByName(chained)
    return out.select(F.col("conv").cast(base.schema["conv"].dataType).alias(id_col), *results[1:])


def damage(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The rows with planted faults, chosen by crc32(`conversation:turn`) % 20, and the column ``copies``.

    0 drops the row (no copies), 1 empties its text, 2 removes its [.!?], 3 repeats it, 4 makes it a user's.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, turn_col, role_col, text_col)]
    kind = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    return rows.select(
        F.col(id_col), F.col(turn_col), F.when(kind == 4, F.lit("user")).otherwise(said[2]).alias(role_col),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(said[3], "[.!?]", "")).otherwise(said[3]).alias(text_col),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
