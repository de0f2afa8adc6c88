"""Conversation structure repair by bidirectional Dijkstra over an edit lattice.

A node of the lattice is (rows consumed, state of the role grammar); its edges
are the edits of the next row (Keep, Rerole, Delete) and Insert.  A forward
heap grows from the start, a reverse heap from the accepted ends.  Once they
meet they go on until no further path can be as cheap, so every node of every
cheapest path is settled on one side.  The crossings mark those paths, and
the least audit is read off by following all of them at once, always along
the least edit.

Roles count by their first character; the grammar is ``(s?(ua)+)?``.  Faults
of a row, the first one counts: blank, duplicate (role and text seen earlier
in the conversation), truncated.  Blank and duplicate rows are deleted.

Two passes.  The first reads rows without their texts (digest, first
character of the role, fault) in conversation order and finds the edits; the
second sends every conversation's edits ahead of its rows and applies them as
the rows stream past.  Both sort in Spark and hold one conversation's edits,
a few bytes a row, never its texts; a very long conversation costs time in
one task, not memory for texts.

Defined results: null role or text: one space; rows in order of turn (null
first), then role, then SHA-256 of the text; a null conversation id is an id;
repeated rows are duplicates; an id all of whose rows are absent: zeros, an
empty audit, no rows; an empty table: no result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import per_partition

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
CLEAN, BLANK, DUPLICATE, CUT_OFF = range(4)
INITIALS = "sua"
#: Per state (start, after s, after u, after a): the state a user or assistant turn leads to ...
STEP = (2, 2, 3, 2)
#: ... which of the two it is, and the states from which a state is reached so.
LETTER = (1, 1, 2, 1)
BEFORE = ((), (), (0, 1, 3), (2,))
#: Answers remembered per worker, for conversations of at most this many rows.
MEMO, MEMO_ROWS = 4096, 64


def keeps(state: int, initial: int) -> int:
    """State after keeping a row with this initial, -1 if the grammar forbids it."""
    if initial == LETTER[state]:
        return STEP[state]
    return 1 if state == 0 and initial == 0 else -1


def _forward(rows: bytes, node: int):
    """(label, cost, next node) of the edges out of a node."""
    at, state = divmod(node, 4)
    yield "I", INSERT, 4 * at + STEP[state]
    if at < len(rows):
        yield "D", DELETE, node + 4
        initial, fault = divmod(rows[at], 4)
        if fault in (CLEAN, CUT_OFF):
            more = TRUNCATED if fault else 0
            kept = keeps(state, initial)
            if kept >= 0:
                yield "K", more, 4 * at + 4 + kept
            yield "R", REROLE + more, 4 * at + 4 + STEP[state]


def _reverse(rows: bytes, node: int):
    """(cost, previous node) of the edges into a node."""
    at, state = divmod(node, 4)
    for p in BEFORE[state]:
        yield INSERT, 4 * at + p
    if at:
        yield DELETE, node - 4
        initial, fault = divmod(rows[at - 1], 4)
        if fault in (CLEAN, CUT_OFF):
            more = TRUNCATED if fault else 0
            for p in BEFORE[state]:
                yield REROLE + more, 4 * at - 4 + p
            for p in range(4):
                if keeps(p, initial) == state:
                    yield more, 4 * at - 4 + p


def _search(rows: bytes) -> tuple[int, array, array]:
    """(least cost, cost from the start, cost to an end); -1 where a side did not settle the node."""
    nodes = 4 * len(rows) + 4
    ahead, back = array("q", [-1]) * nodes, array("q", [-1]) * nodes
    front, rear = [(0, 0)], [(0, nodes - 4), (0, nodes - 1)]
    best = DELETE * len(rows)
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] < rear[0][0]:  # on a tie the ends are settled first
            cost, node = heappop(front)
            if ahead[node] < 0:
                ahead[node] = cost
                if back[node] >= 0:
                    best = min(best, cost + back[node])
                for _, c, to in _forward(rows, node):
                    if ahead[to] < 0:
                        heappush(front, (cost + c, to))
                    if back[to] >= 0:
                        best = min(best, cost + c + back[to])
        else:
            cost, node = heappop(rear)
            if back[node] < 0:
                back[node] = cost
                if ahead[node] >= 0:
                    best = min(best, cost + ahead[node])
                for c, to in _reverse(rows, node):
                    if back[to] < 0:
                        heappush(rear, (cost + c, to))
                    if ahead[to] >= 0:
                        best = min(best, cost + c + ahead[to])
    return best, ahead, back


def edits(rows: bytes) -> tuple[int, str]:
    """(cost, least audit) of the cheapest repair; a row is 4 * initial + fault."""
    best, ahead, back = _search(rows)
    # the crossings, and from them backwards the forward nodes of cheapest paths
    todo = []
    for node in range(len(ahead)):
        if ahead[node] >= 0:
            if back[node] >= 0:
                if ahead[node] + back[node] == best:
                    todo.append(node)
            elif any(back[to] >= 0 and ahead[node] + c + back[to] == best for _, c, to in _forward(rows, node)):
                back[node] = best - ahead[node]
                todo.append(node)
    while todo:
        node = todo.pop()
        for c, to in _reverse(rows, node):
            if ahead[to] >= 0 and back[to] < 0 and ahead[to] + c == ahead[node]:
                back[to] = best - ahead[to]
                todo.append(to)
    audit, at, last = [], {0}, 4 * len(rows)
    while not any(node >= last and back[node] == 0 for node in at):
        steps: dict[str, set[int]] = {}
        for node in at:
            for label, c, to in _forward(rows, node):
                if back[to] >= 0 and back[node] == c + back[to]:
                    steps.setdefault(label, set()).add(to)
        label = min(steps)
        audit.append(label)
        at = steps[label]
    return best, "".join(audit)


_short_edits = lru_cache(MEMO)(edits)


def repaired_edits(rows: bytes) -> tuple[int, str]:
    return _short_edits(rows) if len(rows) <= MEMO_ROWS else edits(rows)


class _Conversation:
    """What the first pass holds of one conversation."""

    def __init__(self, conv):
        self.conv, self.rows, self.faults = conv, bytearray(), [0] * 4
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn, initial: int, fault: int) -> None:
        if turn is not None and turn != self.last:  # rows come in order of turn
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
        if self.rows and (self.rows[-1] // 4, initial) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.rows.append(4 * initial + fault)
        self.faults[fault] += 1

    def result(self) -> dict:
        cost, audit = repaired_edits(bytes(self.rows))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[CUT_OFF], "illegal": self.illegal, "cost": cost, "audit": audit}


def _audits(batches, schema: pa.Schema):
    """One row per conversation from its rows in order."""
    now, out = None, []
    for batch in batches:
        for conv, turn, initial, fault, present in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.result())
                now = _Conversation(conv)
            if present:
                now.add(turn, initial, fault)
        if len(out) >= 1024:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if now is not None:
        out.append(now.result())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _ordered(turns: DataFrame, present: str | None) -> DataFrame:
    """conv_id, turn, role, text (no nulls), digest, present."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"), (F.col(present) if present else F.lit(True)).alias("present"))


def audits(turns: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: one row per conversation.

    ``turns`` has conv_id, turn, role and text.  Rows whose ``present`` column
    is false only name their conversation.
    """
    core = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    narrow = _ordered(turns, present).select(
        "conv_id", "turn", "role", "digest", "present", (core == "").alias("blank"),
        F.right(core, F.lit(1)).isin(".", "!", "?").alias("ended"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"))
    # one exchange by conversation serves the window and the stream of rows
    earlier = Window.partitionBy("conv_id", "present", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(F.col("blank"), BLANK).when(F.row_number().over(earlier) > 1, DUPLICATE)
             .when(~F.col("ended"), CUT_OFF).otherwise(CLEAN))
    rows = (narrow.repartition("conv_id").withColumn("fault", fault)
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest")
            .select("conv_id", "turn", "initial", "fault", "present"))
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])
    return rows.mapInArrow(per_partition(_audits, schema),
                           "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string")


class _Editor:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.head = (len(audit) - audit.count("D")) % 2  # an odd length begins with the system turn

    def _role(self) -> str:
        return "assistant" if (self.place - self.head) % 2 else "user"

    def inserted(self):
        """Turns inserted before the next row (or the end)."""
        while self.audit[self.at:self.at + 1] == "I":
            yield self._role(), ""
            self.place += 1
            self.at += 1

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield (role if edit == "K" else self._role()), text
            self.place += 1


def _streamed(batches):
    """(batch row of the summary, turns) per event: a conversation's summary, then its repaired turns."""
    editor = None
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            row = dict(zip(names, row))
            if row["audit"] is not None:
                if editor is not None:
                    yield None, list(editor.inserted())
                editor = _Editor(row["audit"])
                yield row, list(editor.inserted())
            else:
                yield None, list(editor.row(row["role"], row["text"]))
    if editor is not None:
        yield None, list(editor.inserted())


def _turn_rows(batches, schema: pa.Schema):
    conv, place, out = None, 0, []
    for summary, turns in _streamed(batches):
        if summary is not None:
            conv, place = summary["conv_id"], 0
        for role, text in turns:
            out.append({"conv_id": conv, "place": place, "role": role, "text": text})
            place += 1
        if len(out) >= 256:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _digest_rows(batches, schema: pa.Schema):
    now, sha, first, out = None, None, True, []
    for summary, turns in _streamed(batches):
        if summary is not None:
            if now is not None:
                out.append(now | {"repaired_sha256": sha.hexdigest()})
            now, sha, first = {n: summary[n] for n in schema.names[:-1]}, hashlib.sha256(), True
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        for role, text in turns:
            sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
    if now is not None:
        out.append(now | {"repaired_sha256": sha.hexdigest()})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _events(turns: DataFrame, found: DataFrame, present: str | None) -> DataFrame:
    """Every conversation's summary followed by its rows in order."""
    rows = _ordered(turns, present).filter("present")
    none = [F.lit(None).cast("long").alias(c) for c in COUNTS]
    row = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", *none,
                      F.lit(None).cast("string").alias("audit"))
    head = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                        F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"),
                        *COUNTS, "audit")
    return (head.unionByName(row).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest")
            .select("conv_id", "role", "text", *COUNTS, "audit"))


def repaired_turns(turns: DataFrame, present: str | None = None) -> DataFrame:
    """(conv_id, place, role, text): the repaired conversations."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return _events(turns, audits(turns, present), present).mapInArrow(
        per_partition(_turn_rows, schema), "conv_id long, place long, role string, text string")


def repair_summary(turns: DataFrame, present: str | None = None) -> DataFrame:
    """``audits`` with the SHA-256 of the newline-joined ``role:text`` of the repaired turns."""
    names = ("conv_id", *COUNTS, "audit", "repaired_sha256")
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])
    return _events(turns, audits(turns, present), present).mapInArrow(
        per_partition(_digest_rows, schema),
        ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'long'}" for n in names))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: rows with one of five faults by the hash of conversation and turn."""
    def text_or_space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", text_or_space("conv_id"), text_or_space("turn"))) % 20
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(text_or_space("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text_or_space("text"), ".!?", ""))
        .otherwise(text_or_space("text")).alias("text"), (fault != 0).alias("present"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
