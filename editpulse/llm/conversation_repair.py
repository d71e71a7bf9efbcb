"""Conversations made well-formed by the cheapest edits, found by depth-first branch and bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from editpulse.llm.batches import SLICE_BYTES

# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ROLES = ("user", "assistant")
# Kinds of rows, by the role's initial; a row that has to go is of kind GONE.
OTHER, SYSTEM, USER, ASSISTANT, GONE = range(5)
# States of a repaired prefix, by its last role.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
# A row's first fault.
BLANK, DUPLICATE, CUT_OFF = 1, 2, 3
_FAR = 1 << 40
_TEXT_CHAR = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


class Repair(NamedTuple):
    cost: int
    audit: str


def suffix_bounds(kinds: np.ndarray, truncated: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """For each row on: the least cost when nothing is kept yet, when a user's turn is due, when an assistant's is.

    A lower bound: it lets a lone system row end a conversation, which the search then rules out.
    """
    n = len(kinds)
    start, user, assistant = [0] * (n + 1), [0] * (n + 1), [INSERT] * (n + 1)
    kind, late = kinds.tolist(), truncated.tolist()
    for i in range(n - 1, -1, -1):
        u, a, extra = user[i + 1], assistant[i + 1], TRUNCATED * late[i]
        due_user, due_assistant = DELETE + u, DELETE + a
        if kind[i] != GONE:
            due_user = min(due_user, extra + a + (0 if kind[i] == USER else REROLE))
            due_assistant = min(due_assistant, extra + u + (0 if kind[i] == ASSISTANT else REROLE))
        user[i], assistant[i] = min(due_user, due_assistant + INSERT), min(due_assistant, due_user + INSERT)
        start[i] = min(user[i], DELETE + start[i + 1], extra + u if kind[i] == SYSTEM else _FAR)
    return start, user, assistant


def cheapest_repair(kinds: np.ndarray, truncated: np.ndarray) -> Repair:
    """The least cost of edits that leave ``(s?(ua)+)?``, and the ASCII-least audit of that cost.

    A first descent to the child with the least bound gives an incumbent. The search then visits prefixes in the order
    of their audits (D, I, K, R) from an explicit stack. A prefix is dropped if its cost and suffix bound are over the
    incumbent's cost (once the search has an own incumbent: not under it, for whatever comes later has a larger
    audit), or if its node (row, state) was reached before at no higher cost. When the stack is empty, the incumbent
    is optimal. The bounds are at most the price of one pair off, so a node is visited a few times at most.
    """
    n = len(kinds)
    start, user, assistant = suffix_bounds(kinds, truncated)
    bounds = (start, user, assistant, user)
    kind, late = kinds.tolist(), truncated.tolist()

    def children(i: int, state: int) -> list[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        due = ASSISTANT if state == AFTER_USER else USER
        then = AFTER_ASSISTANT if due == ASSISTANT else AFTER_USER
        if i == n:
            return [] if state in (START, AFTER_ASSISTANT) else [("I", INSERT, i, then)]
        out = [("D", DELETE, i + 1, state), ("I", INSERT, i, then)]
        if kind[i] == GONE:
            return out
        extra = TRUNCATED * late[i]
        if kind[i] == due:
            out.append(("K", extra, i + 1, then))
        else:
            if kind[i] == SYSTEM and state == START:
                out.append(("K", extra, i + 1, AFTER_SYSTEM))
            out.append(("R", REROLE + extra, i + 1, then))
        return out

    i, state, cost, path = 0, START, 0, []
    while more := children(i, state):
        edit, paid, i, state = min(more, key=lambda c: (c[1] + bounds[c[3]][c[2]], c[0]))
        cost += paid
        path.append(edit)
    best, found = Repair(cost, "".join(path)), False

    reached: dict[int, int] = {}
    path = []
    stack = [(0, "", 0, START, 0)]
    while stack:
        depth, edit, i, state, cost = stack.pop()
        bound = cost + bounds[state][i]
        if bound > best.cost or (found and bound == best.cost):
            continue
        node = 4 * i + state
        if reached.get(node, _FAR) <= cost:
            continue
        reached[node] = cost
        if depth:
            del path[depth - 1 :]
            path.append(edit)
        more = children(i, state)
        if not more:
            best, found = Repair(cost, "".join(path)), True
        for edit, paid, row, after in reversed(more):
            stack.append((depth + 1, edit, row, after, cost + paid))
    return best


def _kind(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)


def _plain(turns: DataFrame, **more: Column) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *text, *[c.alias(name) for name, c in more.items()])


def _only_named(conversations: DataFrame, **more: Column) -> DataFrame:
    """One row without a turn for each conversation."""
    nothing = {"turn": F.lit(None).cast("bigint"), "role": F.lit(""), "text": F.lit(""), **more}
    return conversations.select("conv_id", *[c.alias(name) for name, c in nothing.items()])


def _ordered(rows: DataFrame, first: str, *last: Column) -> DataFrame:
    """Rows by conversation in its tasks; ``first`` puts the row that only names it before its turns."""
    order = [F.col(first), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), *last]
    return rows.sortWithinPartitions("conv_id", *order)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """(conv_id, whether it differs from the one before, rows) for runs of rows with one conv_id."""
    last, begun = None, False
    for batch in batches:
        runs = pc.run_end_encode(batch.column("conv_id")) if batch.num_rows else None
        start = 0
        for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()) if runs else ():
            yield value, not begun or value != last, batch.slice(start, end - start)
            last, begun, start = value, True, end


def repairs(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults and the cheapest repair of each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``turns``: conv_id, turn, role, text. ``conversations`` (conv_id) names further ones, which may have no turns left.
    A conversation's rows are taken by turn (nulls first), then role and text. A row's first fault counts: blank (no
    character but space and U+0009 to U+000D), duplicate (role and text of an earlier row), truncated (the last such
    character is none of ``.!?``). Blank and duplicate rows have to be deleted (3); other rows are kept (0), get another
    role (2) or are deleted (3), truncated ones cost 1 more unless deleted; empty user or assistant turns may be
    inserted (2). What is left has role initials ``(s?(ua)+)?``. A role counts by its first character; an empty or
    other one cannot be kept.

    Null roles and texts count as one space, so such texts are blank. A null conv_id is one conversation. gaps is
    maxTurn - minTurn + 1 - distinct turns, without nulls (0 if there are none). illegal counts neighbours whose
    initials are not su, ua or au. Repeated rows are duplicates. A conversation without rows has zeros and an empty
    audit. Other columns are not read.

    Texts are judged before they leave the JVM. A task streams over its conversations and holds numbers for
    the rows of one, never its texts. One conversation is one task's work, as its edits depend on each other.
    """
    kind = turns.schema["conv_id"].dataType
    rows = _plain(turns, given=F.lit(True))
    if conversations is not None:
        rows = rows.unionByName(_only_named(conversations.select("conv_id").distinct(), given=F.lit(False)))
    before = Window.partitionBy("conv_id", "given", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    blank = ~F.col("text").rlike(_TEXT_CHAR)
    fault = F.when(blank, BLANK).when(F.row_number().over(before) > 1, DUPLICATE).when(~F.col("text").rlike(_ENDED), CUT_OFF).otherwise(0)
    judged = rows.repartition("conv_id").withColumns({"fault": fault, "kind": _kind(F.col("role"))})
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def judge(parts: list[pa.RecordBatch]) -> tuple:
        whole = pa.Table.from_batches(parts)
        whole = whole.filter(whole["given"])
        turn = pc.drop_null(whole["turn"]).to_numpy()
        initial, faults = whole["kind"].to_numpy().astype(np.int64), whole["fault"].to_numpy()
        legal = np.isin(initial[:-1] * 8 + initial[1:], [8 * a + b for a, b in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))])
        gone = (faults == BLANK) | (faults == DUPLICATE)
        gaps = turn.max() - turn.min() + 1 - len(np.unique(turn)) if len(turn) else 0
        counts = [int((faults == k).sum()) for k in (BLANK, DUPLICATE, CUT_OFF)]
        return int(gaps), *counts, int((~legal).sum()), *cheapest_repair(np.where(gone, GONE, initial), faults == CUT_OFF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            arrays = [pa.array(columns[0], arrow_kind), *(pa.array(c, pa.int64()) for c in columns[1:-1]), pa.array(columns[-1], pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *names, "audit"])

        for own, new, part in _runs(batches):
            if new and held:
                done.append((last, *judge(held)))
                held = []
                if len(done) >= 1000:
                    yield out()
                    done = []
            last = own
            held.append(part.select(["turn", "kind", "fault", "given"]))
        if held:
            done.append((last, *judge(held)))
            yield out()

    schema = T.StructType([T.StructField("conv_id", kind), *(T.StructField(c, T.LongType()) for c in names), T.StructField("audit", T.StringType())])
    arrow_kind = to_arrow_type(kind)
    # Of equal rows of one turn, the one that is no duplicate comes first.
    return _ordered(judged, "given", F.col("fault") == DUPLICATE).select("conv_id", "turn", "kind", "fault", "given").mapInArrow(run, schema)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str | None, str]]:
    """(conv_id, None, "") where a conversation begins, then (conv_id, role, text) of each repaired turn."""

    def inserted(audit: Iterator[str], own: object) -> Iterator[tuple[object, str, str]]:
        nonlocal edit, due
        edit = next(audit, "")
        while edit == "I":
            yield own, ROLES[due], ""
            due = 1 - due
            edit = next(audit, "")

    edit, due, audit = "", 0, iter("")
    for own, new, part in _runs(batches):
        for given, role, text in zip(*(part.column(c).to_pylist() for c in ("audit", "role", "text"))):
            if given is not None:
                audit, due = iter(given), 0
                yield own, None, ""
                yield from inserted(audit, own)
                continue
            if edit == "R":
                role = ROLES[due]
            if edit != "D":
                yield own, role, text
                due = 0 if role[0] in "sa" else 1
            yield from inserted(audit, own)


def _with_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    audited = _only_named(found, audit=F.col("audit"))
    rows = _plain(turns, audit=F.lit(None).cast("string")).unionByName(audited)
    return _ordered(rows.repartition("conv_id").withColumn("given", F.col("audit").isNull()), "given").drop("given", "turn")


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text. ``found``: what ``repairs`` gave for the same turns."""
    kind = turns.schema["conv_id"].dataType
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = position = 0

        def out() -> pa.RecordBatch:
            types = (arrow_kind, pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["conv_id", "position", "role", "text"])

        for own, role, text in _edited(batches):
            if role is None:
                position = 0
                continue
            rows.append((own, position, role, text))
            size, position = size + len(text) + 40, position + 1
            if size >= SLICE_BYTES:
                yield out()
                rows, size = [], 0
        if rows:
            yield out()

    schema = T.StructType([
        T.StructField("conv_id", kind), T.StructField("position", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])
    return _with_audits(turns, found).mapInArrow(run, schema)


def repaired_digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired ``role:text`` rows joined by newlines; the texts only pass through the task."""
    kind = turns.schema["conv_id"].dataType
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[object] = []
        sums: list[str] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, arrow_kind), pa.array(sums)], names=["conv_id", "repaired_sha256"])

        digest, first = None, True
        for own, role, text in _edited(batches):
            if role is None:
                if digest is not None:
                    sums.append(digest.hexdigest())
                    if len(ids) >= 1000:
                        yield out()
                        ids, sums = [], []
                ids.append(own)
                digest, first = hashlib.sha256(), True
                continue
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if digest is not None:
            sums.append(digest.hexdigest())
            yield out()

    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())])
    return _with_audits(turns, found).mapInArrow(run, schema)
