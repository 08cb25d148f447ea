"""Conversation structure repair: the cheapest edits by bidirectional Dijkstra over the edit lattice.

A conversation is its rows by turn (nulls first; ties by role and text, byte order).
The repaired one's role initials must read ``(s?(ua)+)?``.  Edits: Keep costs 0;
Rerole to user or assistant 3; Delete 4, the only one for a blank row (text without
a character outside 0x20 and 0x09-0x0D) or a duplicate (role and text seen earlier);
Insert an empty user or assistant turn anywhere 3.  A row that isn't deleted
and whose last such character isn't one of ``.!?`` is truncated and adds 3.  Among the cheapest
edit sequences the one whose initials (D, I, K, R) are ASCII-least is the audit.

Method.  Nodes are (rows consumed, state of the role pattern): start, after s, after u,
after a.  A forward search grows from the start, a reverse one from the ends, each
with its heap; the one with the nearer top goes on.  Once the two tops exceed the best
crossing together, every node of every cheapest path is settled on one side, so
all crossings of equal cost are finished.  The least concatenated audit is then read off
from the start: at each node the least letter that still leads to a crossing, past it the
least letter the reverse search holds as cheapest.  From a node a letter leads to one
other node, so this needs no comparison of strings and is linear in the rows.

Work.  Rows are shuffled by conversation and sorted within partitions, and a
task streams them: of each row of the conversation at hand it keeps one byte and a
16-byte digest, and texts up to ``HELD_BYTES``.  A conversation with more text is
repaired without its texts, and its rows are streamed a second time past the audit to
digest them.  So memory doesn't depend on a conversation's text; the digest of one
conversation, by its definition, is read in order by one task.

Rows: one for each conversation id of the input, a null id included: ``gaps`` (turns missing
between the least and the greatest, nulls ignored), ``blank``, ``duplicate`` and
``truncated`` rows (a row counts for its first fault), ``illegal`` (neighbours whose role
initials aren't su, ua or au), ``cost``, ``audit``, and ``repaired_sha256`` of the
repaired ``role:text`` joined by newlines.  A conversation without rows has zeros, an empty
audit and the digest of nothing.  Null roles and texts are one space, so null texts are
blank.  Repeated rows are duplicates.  Other columns aren't used; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import materialize

INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
#: Text of one conversation that a task holds; more is read a second time.
HELD_BYTES = 8 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
_S, _U, _A, _OTHER = range(4)
_GONE, _CUT = 4, 8
#: State after a role, by the state before; None: not allowed there.
_NEXT = {START: {_S: SYSTEM, _U: USER}, SYSTEM: {_U: USER}, USER: {_A: ASSISTANT}, ASSISTANT: {_U: USER}}
#: The only role that Insert and Rerole can give in a state, and the state after it.
_FILL = {START: (_U, USER), SYSTEM: (_U, USER), USER: (_A, ASSISTANT), ASSISTANT: (_U, USER)}
_NAME = {_U: "user", _A: "assistant"}
_SPACE = b" \t\n\v\f\r"


def forward_edges(rows: bytes, node: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next node) from a node, by letter; a node is 4 * rows consumed + state."""
    i, state = node >> 2, node & 3
    filled = _FILL[state][1]
    row = rows[i] if i < len(rows) else None
    if row is not None:
        yield "D", DELETE, node + 4
    yield "I", INSERT, (i << 2) + filled
    if row is not None and not row & _GONE:
        late = TRUNCATED if row & _CUT else 0
        kept = _NEXT[state].get(row & 3)
        if kept is not None:
            yield "K", late, ((i + 1) << 2) + kept
        yield "R", REROLE + late, ((i + 1) << 2) + filled


#: States before a state, for edges that fill in a role.
_FILLED_FROM = {after: [s for s in _FILL if _FILL[s][1] == after] for after in range(4)}


def reverse_edges(rows: bytes, node: int) -> Iterator[tuple[int, int]]:
    """(cost, previous node) of every edge into a node."""
    i, state = node >> 2, node & 3
    for before in _FILLED_FROM[state]:
        yield INSERT, (i << 2) + before
    if i:
        row, below = rows[i - 1], (i - 1) << 2
        yield DELETE, below + state
        if not row & _GONE:
            late = TRUNCATED if row & _CUT else 0
            for before in range(4):
                if _NEXT[before].get(row & 3) == state:
                    yield late, below + before
            for before in _FILLED_FROM[state]:
                yield REROLE + late, below + before


def cheapest_audit(rows: bytes) -> tuple[int, str]:
    """Cost and audit of the repair; a byte of ``rows``: its role's code, plus _GONE, plus _CUT."""
    n = len(rows)
    never = DELETE * n + 2 * INSERT  # more than any cheapest cost: deleting everything is always possible
    near, far = (array("q", [never]) * (4 * n + 4) for _ in range(2))         # least costs so far, forward and reverse
    settled, closed = bytearray(4 * n + 4), bytearray(4 * n + 4)              # which of them are final
    order = array("q")                                                        # settled nodes, first to last
    ends = (n << 2 | START, n << 2 | ASSISTANT)
    near[START] = far[ends[0]] = far[ends[1]] = 0
    # By cost, then by rows done (or still to go): an edge without cost always leads to a later entry.
    ahead, back, best = [(0, 0, START)], [], never

    def spread_back(node: int) -> None:
        for step, to in reverse_edges(rows, node):
            if far[node] + step < far[to]:
                far[to] = far[node] + step
                heapq.heappush(back, (far[to], n - (to >> 2), to))

    for end in ends:
        closed[end] = 1
        spread_back(end)
    while ahead and back and ahead[0][0] + back[0][0] <= best:
        if ahead[0][0] <= back[0][0]:
            cost, _, node = heapq.heappop(ahead)
            if settled[node]:
                continue
            settled[node] = 1
            order.append(node)
            best = min(best, cost + far[node])
            for _, step, to in forward_edges(rows, node):
                if cost + step < near[to]:
                    near[to] = cost + step
                    heapq.heappush(ahead, (cost + step, to >> 2, to))
        else:
            cost, _, node = heapq.heappop(back)
            if closed[node]:
                continue
            closed[node] = 1
            best = min(best, cost + near[node])
            spread_back(node)

    # A forward node leads on if a crossing of the best cost is reached from it; last settled first.
    leads = bytearray(4 * n + 4)

    def goes_on(node: int, step: int, to: int) -> bool:
        if closed[to] and near[node] + step + far[to] == best:
            return True
        return bool(leads[to]) and near[to] == near[node] + step

    for node in reversed(order):
        leads[node] = (closed[node] and near[node] + far[node] == best) or any(
            goes_on(node, step, to) for _, step, to in forward_edges(rows, node))
    out, node, spent = [], START, 0
    while not (closed[node] and spent + far[node] == best):
        letter, step, node = next(e for e in forward_edges(rows, node) if goes_on(node, *e[1:]))
        out.append(letter)
        spent += step
    while far[node] or node >> 2 < n:
        letter, step, node = next(e for e in forward_edges(rows, node) if closed[e[2]] and far[e[2]] + e[1] == far[node])
        out.append(letter)
    return best, "".join(out)


def repaired_lines(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[bytes]:
    """The repaired ``role:text`` lines, given the (role, text) of all rows in order."""
    state = START
    for letter in audit:
        if letter == "I":
            role, state = _FILL[state]
            yield f"{_NAME[role]}:".encode()
            continue
        was, text = next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = _NEXT[state][_code(was)]
        else:
            role, state = _FILL[state]
            was = _NAME[role]
        yield f"{was}:{text}".encode("utf-8", "surrogatepass")


def _code(role: str) -> int:
    return {"s": _S, "u": _U, "a": _A}.get(role[:1], _OTHER)


class _Digest:
    def __init__(self):
        self.sha, self.some = hashlib.sha256(), False

    def add(self, line: bytes) -> None:
        if self.some:
            self.sha.update(b"\n")
        self.sha.update(line)
        self.some = True


class Conversation:
    """What is kept of a conversation while its rows go by."""

    def __init__(self):
        self.rows, self.seen = bytearray(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.most = self.last_turn = None
        self.turns = 0
        self.before: str | None = None
        self.texts: list[tuple[str, str]] | None = []
        self.size = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last_turn
            self.most = self.last_turn = turn
        raw = text.encode("utf-8", "surrogatepass")
        key = hashlib.blake2b(b"%d:" % len(role) + role.encode("utf-8", "surrogatepass") + raw, digest_size=16).digest()
        body = raw.rstrip(_SPACE)
        code = _code(role)
        if not body:
            self.blank += 1
            code |= _GONE
        elif key in self.seen:
            self.duplicate += 1
            code |= _GONE
        elif body[-1:] not in (b".", b"!", b"?"):
            self.truncated += 1
            code |= _CUT
        self.seen.add(key)
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.rows.append(code)
        if self.texts is not None:
            self.size += len(raw) + len(role)
            self.texts.append((role, text if not code & _GONE else ""))
            if self.size > HELD_BYTES:
                self.texts = None

    def result(self) -> tuple:
        cost, audit = cheapest_audit(bytes(self.rows))
        sha = None
        if self.texts is not None:
            digest = _Digest()
            for line in repaired_lines(audit, iter(self.texts)):
                digest.add(line)
            sha = digest.sha.hexdigest()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, sha


_RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _streams(df: DataFrame) -> DataFrame:
    """Rows of a conversation next to each other, in order, in one partition."""
    return df.repartition("conv").sortWithinPartitions("conv", F.col("kind"), F.col("turn").asc_nulls_first(), "role", "text")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            yield from b.slice(at, 256).to_pylist()


def _flush(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], field.type) for k, field in enumerate(schema)], schema=schema)


def _summaries(ids: T.DataType):
    out = T.StructType([T.StructField("conv", ids), *(T.StructField(c, T.LongType()) for c in _RESULT[:6]),
                        *(T.StructField(c, T.StringType()) for c in _RESULT[6:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, found, conv, held = None, [], None, None
        for b in batches:
            if schema is None:
                schema = pa.schema([pa.field("conv", b.schema.field("conv").type), *(pa.field(c, pa.int64()) for c in _RESULT[:6]),
                                    *(pa.field(c, pa.string()) for c in _RESULT[6:])])
            for row in _each([b]):
                if held is None or row["conv"] != conv:
                    if held is not None:
                        found.append((conv, *held.result()))
                    conv, held = row["conv"], Conversation()
                if row["kind"]:
                    held.add(row["turn"], row["role"], row["text"])
            if len(found) >= 500:
                yield _flush(found, schema)
                found = []
        if held is not None:
            found.append((conv, *held.result()))
            yield _flush(found, schema)

    return run, out


def _digests(ids: T.DataType):
    out = T.StructType([T.StructField("conv", ids), T.StructField("sha", T.StringType())])

    def lines(conv_rows: Iterator[dict]) -> Iterator[tuple[str, str]]:
        for row in conv_rows:
            yield row["role"], row["text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _each(batches)
        row = next(rows, None)
        while row is not None:  # the audit (kind 0) comes before the rows of its conversation
            conv, audit, digest = row["conv"], row["text"], _Digest()

            def own() -> Iterator[tuple[str, str]]:
                nonlocal row
                while row is not None and row["conv"] == conv:
                    yield row["role"], row["text"]
                    row = next(rows, None)

            row = next(rows, None)
            for line in repaired_lines(audit, own()):
                digest.add(line)
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.sha.hexdigest()])], names=["conv", "sha"])
            while row is not None and row["conv"] == conv:
                row = next(rows, None)

    return run, out


def repair(turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
           text_column: str = "text", present: Column | None = None) -> DataFrame:
    """One row per conversation id of ``turns``.  ``present``: rows that count (others only name their conversation)."""
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = turns.select(F.col(conv_column).alias("conv"), F.when(there, 1).otherwise(0).alias("kind"),
                        F.when(there, F.col(turn_column).cast("long")).alias("turn"),
                        F.when(there, F.coalesce(role_column, F.lit(" "))).alias("role"),
                        F.when(there, F.coalesce(text_column, F.lit(" "))).alias("text"))
    ids = turns.schema[conv_column].dataType
    run, schema = _summaries(ids)
    found = materialize(_streams(rows).mapInArrow(run, schema), "conversations")
    long = found.where(F.col("repaired_sha256").isNull())
    if not long.isEmpty():
        again, short = _digests(ids)
        audits = long.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                             F.col("audit").alias("text"))
        named = long.select(F.col("conv").alias("long_conv"))
        theirs = rows.where(F.col("kind") == 1).join(named, F.col("conv").eqNullSafe(F.col("long_conv")), "left_semi")
        sha = _streams(audits.unionByName(theirs)).mapInArrow(again, short).withColumnRenamed("conv", "sha_conv")
        found = found.join(sha, F.col("conv").eqNullSafe(F.col("sha_conv")), "left").withColumn(
            "repaired_sha256", F.coalesce("repaired_sha256", "sha")).drop("sha_conv", "sha")
    return found.withColumnRenamed("conv", conv_column)


def damaged(turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
            text_column: str = "text") -> DataFrame:
    """``turns`` with faults put in by a rule: (conv_id, turn, role, text, present).

    crc32 of ``conv_id:turn`` (a null is one space) modulo 20: 0 drops the row (present is
    false), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced(conv_column), F.lit(":"), spaced(turn_column)).cast("binary")) % 20
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = turns.select(F.col(conv_column).alias("conv_id"), F.col(turn_column).alias("turn"), spaced(role_column).alias("role"),
                        spaced(text_column).alias("text"), kind.alias("_kind"))
    return rows.select("*", copies.alias("_copy")).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_kind") != 0).alias("present"))
