"""Repair of the structure of conversations by cheapest edits.

Rows of a conversation are taken by turn (nulls first; ties by role, then by a digest of role and text). A row's first
fault counts: it is blank, a duplicate (its role and text were seen earlier in the conversation), or truncated (its last
character that is no blank ends no sentence). Edits are K (keep), R (give the row the role user or assistant), D (delete) and I
(insert an empty row); blank rows and duplicates must go. The roles that result, by their initials, follow ``(s?(ua)+)?``.

The edits form a lattice of (turn index, grammar state) nodes that is never built: Dijkstra's algorithm pops nodes by
(cost, audit), the audit being the edits' initials, and stops at the first popped accepting end node. Paths to one node that cost the
same can't be prefixes of each other (they consume the same rows, and an insertion costs), so what is least up to a node stays least
whatever follows. For the same reason a long conversation is taken in stretches of ``STRETCH`` rows: each stretch is solved from
every state that is alive, the four results are joined up, and what all of them begin with is final.

Two passes, both in the order of the rows. The first exchanges a digest and a few flags of each row, no text, and gives one plan per
conversation; a task holds one stretch, the plan and 16 bytes for each distinct row of one conversation. The second brings plans and texts together and
gives repaired rows, or their digest, row after row: no conversation's texts are ever held together. One conversation is one ordered
unit and stays in one task, as its plan is one value; tasks are dealt out by conversation.

Nulls in role and text are one space (a blank text; a role that no grammar has). A role's initial is its first character; an empty role has
none and can't be kept. A null id is a conversation of its own. Repeated rows are duplicates. A row that is only ``present`` false
names its conversation: one without any row has zeros, an empty audit and the digest of the empty string. An empty table gives
no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settings

STRETCH = 64
OUT_ROWS = 4096
OUT_BYTES = 4 << 20

#: What an edit costs; a truncated row that isn't deleted costs one more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

#: Grammar states: nothing yet, after s, after u, after a. The role that may follow by insertion or a new role, and the state then.
_NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_ACCEPTING = (0, 3)

#: One character of a row's code: x must go; s, u, a are initials, - is any other; capitals and _ for truncated rows.
_GONE, _OTHER = "x", "-"
_TRUNCATED = str.maketrans("sua-", "SUA_")
_PLAIN = {"S": "s", "U": "u", "A": "a", "_": "-"}


def _search(code: str, start: int, whole: bool) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the cheapest edits of the coded rows from ``start`` to each state behind them; only the best
    accepting one if they are ``whole``."""
    heap, best, done, ends = [(0, "", 0, start)], {}, set(), {}
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(code):
            if not whole:
                ends[state] = (cost, audit)
            elif state in _ACCEPTING:
                return {state: (cost, audit)}
        steps = [(INSERT, "I", at, _NEXT[state][1])]
        if at < len(code):
            steps.append((DELETE, "D", at + 1, state))
            if (row := code[at]) != _GONE:
                more = TRUNCATED * (row in _PLAIN)
                steps.append((REROLE + more, "R", at + 1, _NEXT[state][1]))
                if (kept := _KEPT.get((state, _PLAIN.get(row, row)))) is not None:
                    steps.append((KEEP + more, "K", at + 1, kept))
        for price, edit, to, then in steps:
            key = (cost + price, audit + edit)
            if (to, then) not in done and ((to, then) not in best or key < best[to, then]):
                best[to, then] = key
                heapq.heappush(heap, (*key, to, then))
    return ends


_searched = lru_cache(1 << 14)(_search)


class _Lattice:
    """Cheapest edits of rows that come one by one."""

    def __init__(self):
        self.code, self.settled, self.alive = [], [], {0: (0, "")}

    def put(self, code: str) -> None:
        self.code.append(code)
        if len(self.code) > STRETCH:
            self._join_up("".join(self.code[:STRETCH]))
            del self.code[:STRETCH]

    def _join_up(self, code: str) -> None:
        found: dict[int, tuple[int, str]] = {}
        for state, (cost, audit) in self.alive.items():
            for end, (more, edits) in _searched(code, state, False).items():
                key = (cost + more, audit + edits)
                if end not in found or key < found[end]:
                    found[end] = key
        shared = commonprefix([audit for _, audit in found.values()])
        self.settled.append(shared)
        self.alive = {s: (cost, audit[len(shared) :]) for s, (cost, audit) in found.items()}

    def finish(self) -> tuple[int, str]:
        code = "".join(self.code)
        ends = [(cost + more, audit + edits) for state, (cost, audit) in self.alive.items() for more, edits in _searched(code, state, True).values()]
        cost, audit = min(ends)
        return cost, "".join(self.settled) + audit


PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PLAN_TYPES = [pa.int64()] * 6 + [pa.string()]
_LEGAL = {"su", "ua", "au"}


class _Plan:
    """Faults and cheapest edits of one conversation."""

    def __init__(self):
        self.rows = self.turns = self.illegal = 0
        self.first = self.last = self.initial = None
        self.faults, self.seen, self.lattice = [0, 0, 0], set(), _Lattice()

    def put(self, turn: int | None, initial: str, digest: bytes, blank: bool, cut: bool) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        self.illegal += self.rows > 0 and self.initial + initial not in _LEGAL
        self.initial, self.rows = initial, self.rows + 1
        code = initial if initial in ("s", "u", "a") else _OTHER
        if blank or digest in self.seen:
            self.faults[0 if blank else 1] += 1
            code = _GONE
        elif cut:
            self.faults[2] += 1
            code = code.translate(_TRUNCATED)
        self.seen.add(digest)
        self.lattice.put(code)

    def finish(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults, self.illegal, *self.lattice.finish())


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, names, plan, key, out = None, None, None, None, []

    def put_out():
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [kind, *_PLAN_TYPES], strict=True)], names)

    for batch in batches:
        kind, names = batch.schema.field(0).type, ["conv_id", *[x.split()[0] for x in PLAN.split(", ")]]
        for conv, present, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if plan is None or conv != key:
                if plan is not None:
                    out.append((key, *plan.finish()))
                plan, key = _Plan(), conv
                if len(out) >= OUT_ROWS:
                    yield put_out()
                    out = []
            if present:
                plan.put(*row)
    if plan is not None:
        out.append((key, *plan.finish()))
    if out:
        yield put_out()


def _flagged(rows: DataFrame, present: Column) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    named = rows.select("conv_id", F.coalesce(present, F.lit(False)).alias("present"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return named.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)))


#: Spark sorts nulls first.
_ORDER = ["turn", "role", "digest"]


def plan_repairs(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: its faults and the edits that repair it at least cost (``PLAN``)."""
    settings(rows.sparkSession)
    flagged = _flagged(rows, F.lit(True) if present is None else present)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    # no more than 16 bytes of the digest tell the rows of a conversation apart, and order ties
    small = flagged.select("conv_id", "present", "turn", F.substring("role", 1, 1).alias("initial"), F.substring("digest", 1, 16).alias("digest"), blank.alias("blank"), cut.alias("cut"), "role")
    dealt = small.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER).drop("role")
    return dealt.mapInArrow(_plans, f"conv_id {_kind(rows)}, {PLAN}")


def _kind(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, plan, None) where one begins, then (conversation, None, (edit, turn, role, text)) for each row that stays, in order."""
    key = plan = audit = None
    at = state = 0

    def inserted():
        nonlocal at, state
        while audit[at : at + 1] == "I":
            role, state = _NEXT[state]
            at += 1
            yield key, None, ("I", None, role, "")

    for batch in batches:
        for conv, found, turn, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if found is not None:
                if plan is not None:
                    yield from inserted()
                key, plan, audit, at, state = conv, found, found["audit"], 0, 0
                yield key, plan, None
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = _KEPT[state, role[:1]]
                yield key, None, (edit, turn, role, text)
            elif edit == "R":
                role, state = _NEXT[state]
                yield key, None, (edit, turn, role, text)
    if plan is not None:
        yield from inserted()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, out, size, at = {}, [], 0, 0

    def typed(batches):
        for batch in batches:
            kinds["conv_id"] = batch.schema.field(0).type
            yield batch

    def put_out():
        types = [kinds["conv_id"], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["conv_id", "at", "edit", "turn", "role", "text"])

    for conv, plan, row in _edited(typed(batches)):
        if plan is not None:
            at = 0
            continue
        out.append((conv, at, *row))
        at, size = at + 1, size + len(row[3])
        if len(out) >= OUT_ROWS or size >= OUT_BYTES:
            yield put_out()
            out, size = [], 0
    if out:
        yield put_out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, out, digest = {}, [], None

    def typed(batches):
        for batch in batches:
            kinds["types"] = [batch.schema.field(0).type, *_PLAN_TYPES, pa.string()]
            yield batch

    def put_out():
        names = ["conv_id", *[x.split()[0] for x in PLAN.split(", ")], "repaired_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds["types"], strict=True)], names)

    for conv, plan, row in _edited(typed(batches)):
        if plan is not None:
            if digest is not None:
                out[-1] += (digest.hexdigest(),)
                if len(out) >= OUT_ROWS:
                    yield put_out()
                    out = []
            digest, begun = hashlib.sha256(), False
            out.append((conv, *plan.values()))
            continue
        digest.update(b"\n" * begun + f"{row[2]}:{row[3]}".encode())
        begun = True
    if digest is not None:
        out[-1] += (digest.hexdigest(),)
        yield put_out()


def _dealt(rows: DataFrame, plans: DataFrame, present: Column) -> DataFrame:
    """Each conversation's plan, then its rows in order: (conv_id, plan, turn, role, text)."""
    names = [x.split()[0] for x in PLAN.split(", ")]
    heads = plans.select("conv_id", F.struct(*names).alias("plan"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "binary"))])
    body = _flagged(rows, present).where("present").select("conv_id", F.lit(None).cast(heads.schema["plan"].dataType).alias("plan"), "turn", "role", "text", F.substring("digest", 1, 16).alias("digest"))
    both = heads.unionByName(body).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", F.col("plan").isNull(), *_ORDER).select("conv_id", "plan", "turn", "role", "text")


def repaired_rows(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """The repaired conversations' rows: (conv_id, at, edit, turn, role, text), ``at`` counting from 0, inserted rows without a turn."""
    present = F.lit(True) if present is None else present
    return _dealt(rows, plan_repairs(rows, present), present).mapInArrow(_repaired, f"conv_id {_kind(rows)}, at long, edit string, turn long, role string, text string")


def repair_conversations(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: its plan, and the digest of the repaired lines ``role:text``."""
    present = F.lit(True) if present is None else present
    return _dealt(rows, plan_repairs(rows, present), present).mapInArrow(_digests, f"conv_id {_kind(rows)}, {PLAN}, repaired_sha256 string")
