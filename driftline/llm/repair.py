"""Repair of conversations by least-cost edits, with checkpoints of backward cost vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import null_safe_join
from .common import Stages, ship, slices, worker_state

ship(__name__)

#: Rows of a segment; the vectors between segments are the outer checkpoints.
SEGMENT_ROWS = 1 << 14
#: ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"
#: States by what the repaired roles end with: nothing, system, user, assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled turn; the only turn that may follow.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLES = ("", "system", "user", "assistant")
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5
#: Costs from the end of a conversation on.
AT_END = (0, 2 * INSERT, INSERT, 0)
#: Faults of a row; the last two are always deleted.
SOUND, CUT, BLANK, DUPLICATE = range(4)
INITIALS = "sua"
UNREACHED = 1 << 60


def kept_state(code: int, state: int) -> int | None:
    """The state after a row is kept, None where it may not follow. A code is 4 * fault + initial."""
    initial = code % 4
    if initial == 0:
        return SYSTEM if state == NOTHING else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def row_edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of what may happen to a row, in ASCII order."""
    edits = [("D", DELETE, state)]
    fault = code // 4
    if fault in (SOUND, CUT):
        more = TRUNCATED if fault == CUT else 0
        kept = kept_state(code, state)
        if kept is not None:
            edits.append(("K", KEEP + more, kept))
        edits.append(("R", REROLE + more, FOLLOWING[state]))
    return edits


def _before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs from before a row on, by state; turns may be inserted before it."""
    costs = [
        min(min(cost + after[then], UNREACHED) for _, cost, then in row_edits(code, state))
        for state in range(4)
    ]
    user, assistant = costs[USER], costs[ASSISTANT]
    costs[USER] = min(user, INSERT + assistant)
    costs[ASSISTANT] = min(assistant, INSERT + user)
    for state in (NOTHING, SYSTEM):
        costs[state] = min(costs[state], INSERT + costs[USER])
    return tuple(min(c, UNREACHED) for c in costs)


def _relative(vector: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    least = min(vector)
    return least, tuple(c - least if c < UNREACHED else UNREACHED for c in vector)


class Steps:
    """Remembers what a row does to a vector of relative costs; few vectors ever occur."""

    def __init__(self) -> None:
        self.backward: dict = {}
        self.forward: dict = {}

    def back(self, code: int, after: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
        """(what the least cost grows by, relative costs before the row)."""
        key = (code, after)
        found = self.backward.get(key)
        if found is None:
            found = self.backward[key] = _relative(_before(code, after))
        return found

    def walk(self, code: int, after: tuple[int, ...], state: int) -> tuple[bytes, int]:
        """The ASCII-least tight edits up to the row's own, and the state behind it."""
        key = (code, after, state)
        found = self.forward.get(key)
        if found is None:
            found = self.forward[key] = _tight(code, after, state)
        return found


def _tight(code: int, after: tuple[int, ...], state: int) -> tuple[bytes, int]:
    before, done = _before(code, after), ""
    while True:
        edits = row_edits(code, state)
        then = FOLLOWING[state]
        choices = [(edit, after[to] + cost, to) for edit, cost, to in edits]
        choices.append(("I", INSERT + before[then], then))
        edit, _, to = min(c for c in choices if c[1] == before[state])
        done += edit
        state = to
        if edit != "I":
            return done.encode(), state


def _steps() -> Steps:
    return worker_state("repair-steps", Steps)


def transfer(codes: bytes) -> list[int]:
    """Least costs of a segment from each state before it (rows) to each behind it (columns)."""
    steps, columns = _steps(), []
    for last in range(4):
        total, vector = 0, tuple(0 if s == last else UNREACHED for s in range(4))
        for code in reversed(codes):
            grown, vector = steps.back(code, vector)
            total += grown
        columns.append([c + total if c < UNREACHED else UNREACHED for c in vector])
    return [columns[last][first] for first in range(4) for last in range(4)]


def through(matrix: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a segment from that behind it."""
    return tuple(
        min(min(matrix[4 * first + last] + after[last] for last in range(4)), UNREACHED)
        for first in range(4)
    )


def segment_edits(codes: bytes, after: tuple[int, ...]) -> list[tuple[bytes, int]]:
    """(edits, state behind the segment) for each of the four states before it.

    Backward vectors are kept at every square root of its length only; on the way forward a
    block's vectors are computed again from the checkpoint behind it.
    """
    steps, width = _steps(), isqrt(len(codes)) + 1
    vector = _relative(after)[1]
    checkpoints = {len(codes): vector}
    for place in range(len(codes) - 1, -1, -1):
        vector = steps.back(codes[place], vector)[1]
        if place % width == 0:
            checkpoints[place] = vector
    done, states = [bytearray() for _ in range(4)], list(range(4))
    for start in range(0, len(codes), width):
        end = min(start + width, len(codes))
        behind = [checkpoints[end]]
        for place in range(end - 1, start, -1):
            behind.append(steps.back(codes[place], behind[-1])[1])
        for place in range(start, end):
            vector = behind.pop()
            for first in range(4):
                edits, states[first] = steps.walk(codes[place], vector, states[first])
                done[first] += edits
    return [(bytes(d), s) for d, s in zip(done, states)]


def _segments(judged: DataFrame) -> DataFrame:
    """Rows (conv_id, segment, codes, matrix): the rows of a conversation in order, cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(conv, number: int, codes: bytearray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv], pa.int64()),
                    pa.array([(part << 40) + number], pa.int64()),
                    pa.array([bytes(codes)], pa.binary()),
                    pa.array([transfer(bytes(codes))], pa.list_(pa.int64())),
                ],
                names=["conv_id", "segment", "codes", "matrix"],
            )

        part, number, last, codes = TaskContext.get().partitionId(), 0, None, bytearray()
        for batch in slices(batches):
            for conv, copies, code in zip(*[c.to_pylist() for c in batch.columns]):
                if codes and (conv != last or len(codes) >= SEGMENT_ROWS):
                    yield out(last, number, codes)
                    number, codes = number + 1, bytearray()
                last = conv
                codes.append(code)
                if copies > 1:
                    again = code if code // 4 == BLANK else 4 * DUPLICATE + code % 4
                    codes += bytes([again]) * (copies - 1)
        if codes:
            yield out(last, number, codes)

    order = ["conv_id", "turn", "role", "digest"]
    dealt = judged.select(*order, "copies", "code").repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).select("conv_id", "copies", "code").mapInArrow(
        cut, "conv_id long, segment long, codes binary, matrix array<bigint>"
    )


def _checkpoints(segments: DataFrame) -> DataFrame:
    """Segments with ``after``, the backward vector behind each."""

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, vector = object(), AT_END
        for batch in slices(batches):
            behind = []
            for conv, matrix in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                vector = vector if conv == last else AT_END
                behind.append(list(vector))
                last, vector = conv, through(matrix, vector)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(behind, pa.list_(pa.int64()))],
                names=["conv_id", "segment", "codes", "after"],
            )

    backward = segments.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("segment"))
    return backward.mapInArrow(
        chained, "conv_id long, segment long, codes binary, after array<bigint>"
    )


def _edited(checked: DataFrame) -> DataFrame:
    """Segments with the edits and the state behind them, for each state before them."""

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                segment_edits(codes, tuple(after))
                for codes, after in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([[e for e, _ in f] for f in found], pa.list_(pa.binary())),
                    pa.array([[s for _, s in f] for f in found], pa.list_(pa.int64())),
                ],
                names=["conv_id", "segment", "edits", "states"],
            )

    return checked.repartition("conv_id", "segment").mapInArrow(
        edited, "conv_id long, segment long, edits array<binary>, states array<bigint>"
    )


class Replay:
    """One conversation read in order: its faults, and its repaired turns by the edits."""

    def __init__(self, conv: int | None, turn_of) -> None:
        self.conv, self.turn_of = conv, turn_of
        self.audit, self.entered = bytearray(), NOTHING
        self.place, self.state, self.waiting = 0, NOTHING, None
        self.turns = [None, None, 0]  # first, last, distinct
        self.faults, self.illegal, self.cost, self.initial = [0] * 4, 0, 0, None
        self.count, self.sha = 0, hashlib.sha256()

    def segment(self, edits: list[bytes], states: list[int]) -> None:
        self.audit += edits[self.entered]
        self.entered = states[self.entered]

    def turn(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.count else ''}{role}:{text}".encode())
        self.turn_of(self.conv, self.count, role, text)
        self.count += 1

    def insert(self) -> None:
        self.cost += INSERT
        self.state = FOLLOWING[self.state]
        self.turn(ROLES[self.state], "")

    def line(self, turn: int | None, role: str, copies: int, code: int, key: tuple) -> None:
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
        fault, initial = code // 4, role[:1]
        self.faults[fault] += 1
        self.faults[fault if fault == BLANK else DUPLICATE] += copies - 1
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.initial, self.waiting = initial, None
        while self.audit[self.place : self.place + 1] == b"I":
            self.insert()
            self.place += 1
        edit = self.audit[self.place : self.place + 1]
        self.place += copies  # what repeats a row in its place is deleted
        self.cost += DELETE * (copies - 1)
        if edit == b"D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED if fault == CUT else 0
        if edit == b"R":
            self.cost += REROLE
            self.state = FOLLOWING[self.state]
            role = ROLES[self.state]
        else:
            self.state = kept_state(code, self.state)
        self.waiting = (key, role)

    def text(self, key: tuple, text: str) -> None:
        if self.waiting and self.waiting[0] == key:
            self.turn(self.waiting[1], text)
            self.waiting = None

    def finish(self) -> tuple:
        while self.state not in (NOTHING, ASSISTANT):
            self.insert()
            self.audit += b"I"
        first, last, distinct = self.turns
        gaps = 0 if first is None else last - first + 1 - distinct
        return (
            self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT],
            self.illegal, self.cost, self.audit.decode(), self.sha.hexdigest(),
        )


REPORT = pa.schema(
    [("conv_id", pa.int64())]
    + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
TURNS = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]
)


def _replayed(stream: DataFrame, turns: bool) -> DataFrame:
    def replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, schema = [], TURNS if turns else REPORT

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(schema)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )
            rows.clear()
            return batch

        turn_of = (lambda *turn: rows.append(turn)) if turns else (lambda *turn: None)
        now: Replay | None = None
        for batch in slices(batches):
            for conv, kind, turn, role, digest, text, copies, code, edits, states in zip(
                *[c.to_pylist() for c in batch.columns]
            ):
                if now is None or conv != now.conv:
                    if now is not None:
                        report = now.finish()
                        if not turns:
                            rows.append(report)
                    now = Replay(conv, turn_of)
                if kind == 1:
                    now.segment(edits, states)
                elif kind == 2 and code is not None:
                    now.line(turn, role, copies, code, (turn, role, digest))
                elif kind == 2:
                    now.text((turn, role, digest), text)
            yield out()
        if now is not None:
            report = now.finish()
            if not turns:
                rows.append(report)
            yield out()

    kinds = (
        "conv_id long, place long, role string, text string"
        if turns
        else "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string, repaired_sha256 string"
    )
    return stream.mapInArrow(replayed, kinds)


def _lines(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, digest, blank, cut), nulls of role and text as a space."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    trimmed = F.rtrim(text, F.lit(BLANKS))
    return rows.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.sha2(text, 256).alias("digest"),
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )


def repair_conversations(
    rows: DataFrame,
    conversations: DataFrame | None = None,
    turns: bool = False,
    stages: Stages | None = None,
) -> DataFrame:
    """The report of every conversation, or with ``turns`` its repaired turns (place, role, text).

    A conversation's rows (conv_id, turn, role, text) stand by turn, nulls first, those of one
    turn by role and digest of the text. The cheapest edits give the role initials
    ``(s?(ua)+)?``: keep 0, rerole to user or assistant 1, delete 2, insert an empty user or
    assistant turn 5, and 5 for a truncated row that is not deleted; blank rows and repetitions
    of a role and text are always deleted. Of equally cheap edits the ASCII-least string counts.

    Equal rows are counted before they move. The rows, without their texts, are range-partitioned
    and cut into segments; a segment's transfer costs are chained from the end of a conversation,
    which leaves the backward cost vector at every segment as a checkpoint; segments are then
    walked forward apart from each other, for each state they may be entered in, with inner
    checkpoints at every square root of their rows. At last a conversation's rows are read in
    order beside its edits, since its digest needs one order.

    ``conversations`` (conv_id) adds conversations that have no rows: zeros and empty edits.
    Null roles and texts are one space, a null conv_id is a conversation of its own. Texts of any
    length are read whole. An empty table gives no rows. Other columns are not read.
    """
    stages = stages or Stages(rows.sparkSession)
    lines = _lines(rows)
    names = ["conv_id", "turn", "role", "digest"]
    known = lines.groupBy(*names).agg(
        F.count(F.lit(1)).alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut")
    )
    known = stages.put(known, "lines")
    turn_key = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = known.groupBy("conv_id", "role", "digest").agg(F.min(turn_key).alias("first"))
    firsts = stages.put(firsts, "first-lines")
    judged = null_safe_join(known, firsts, ["conv_id", "role", "digest"], "inner")
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(~F.col("turn").eqNullSafe(F.col("first.turn")), DUPLICATE)
        .when(F.col("cut"), CUT)
        .otherwise(SOUND)
    )
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    judged = stages.put(judged.select(*names, "copies", (4 * fault + place).alias("code")), "judged")

    segments = stages.put(_segments(judged), "segments")
    edits = stages.put(_edited(stages.put(_checkpoints(segments), "checkpoints")), "edits")

    empty = {
        "segment": "long", "turn": "long", "role": "string", "digest": "string", "text": "string",
        "copies": "long", "code": "int", "edits": "array<binary>", "states": "array<bigint>",
    }

    def part(frame: DataFrame, kind: int) -> DataFrame:
        return frame.select(
            "conv_id",
            F.lit(kind).alias("kind"),
            *[
                (F.col(name) if name in frame.columns else F.lit(None)).cast(dtype).alias(name)
                for name, dtype in empty.items()
            ],
        )

    stream = part(edits, 1).unionByName(part(judged, 2)).unionByName(
        part(lines.filter("NOT blank").select(*names, "text"), 2)
    )
    if conversations is not None:
        every = conversations.select(F.col("conv_id").cast("long")).distinct()
        stream = stream.unionByName(part(every, 0))
    stream = stream.repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", "segment", "turn", "role", "digest", F.col("code").asc_nulls_last()
    )
    columns = ["conv_id", "kind", "turn", "role", "digest", "text", "copies", "code", "edits", "states"]
    return _replayed(stream.select(*columns), turns)
