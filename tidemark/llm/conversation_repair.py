"""Conversation structure repair: the cheapest edits that make every conversation an exchange of turns.

Rows (conv_id, turn, role, text) are repartitioned by conversation and sorted by turn (nulls first), role and text; a
task streams past them and carries, from Arrow batch to Arrow batch, the state of a dynamic programme over the four
places of `(s?(ua)+)?`: at the start, after s, after u, after a. A row is kept (cost 0), gets the role that fits (1) or is
deleted (2); rows with an empty text may be inserted (5). Blank rows and duplicates must be deleted; a truncated row that
stays costs 5 more. Of equal costs the audit (the edits' initials, in order) that is ASCII-least wins: after each row the
best audits of the four places differ and none starts another, so their order is all that has to be carried. Costs above
the least and that order take few values, so they are numbered as the stream meets them, and a row is one look-up.

Each row leaves a backpointer for each place, one byte each. Conversations of up to `most_rows` rows and `most_chars` characters are traced
back at once. Those of giant ones are spilled: parts of backpointers go to a table in the shared folder, a second stream
takes a conversation's parts from the last to the first and writes what to do with each row, and a third applies it to
the rows, sorted as before. So no text of a giant conversation waits in memory, only a byte a row.

A row is a duplicate if its role and text stand earlier in its conversation: the least turn of each role and text (by
SHA-256) is aggregated before the stream, which then only compares a row with the one before it.

Defined results: a null role or text reads as one space; a null turn comes first; a null conv_id is a conversation of its own; rows
of one turn are ordered by role and text, so repeated rows are neighbours; a role of no character can't be kept; very
long texts are passed on whole, one at a time; empty tables give empty results; extra columns are left out, whatever they
are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import parallelism, shape, written

SPACES = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role of each initial may stand, and where it leads; an inserted or changed role is the one that fits there.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FITS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Edits of a row, after so many insertions: step 3 * insertions + (0 delete, 1 keep, 2 change the role).
STEPS = [n * "I" + e for n in range(3) for e in "DKR"]
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Kinds of rows: initial (s, u, a, other), plus 4 if truncated; or to be deleted.
MUST_DELETE = 8
GAP = 1 << 14


class Machine:
    """The dynamic programme as a machine whose states are costs above the least and the audits' order."""

    def __init__(self):
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.known: dict[tuple[int, int], tuple[int, int, bytes]] = {}
        self.start = self._state(((0, 0), None, None, None))

    def _state(self, places: tuple) -> int:
        if places not in self.number:
            self.number[places] = len(self.states)
            self.states.append(places)
        return self.number[places]

    def step(self, state: int, kind: int) -> tuple[int, int, bytes]:
        """The next state, what the least cost grows by, and for each place 16 * the place before + the step taken."""
        if (found := self.known.get((state, kind))) is None:
            found = self.known[state, kind] = self._step(state, kind)
        return found

    def _step(self, state: int, kind: int) -> tuple[int, int, bytes]:
        best: list[tuple | None] = [None] * 4
        for origin, own in enumerate(self.states[state]):
            if own is None:
                continue
            place, cost, rank = origin, *own
            for n in range(3):
                ways = [(place, DELETE, 0)]
                if kind != MUST_DELETE:
                    stays = TRUNCATED if kind & 4 else 0
                    to = KEPT.get("sua_"[kind & 3], {}).get(place)
                    ways += ([(to, stays, 1)] if to is not None else []) + [(FITS[place], stays + REROLE, 2)]
                for to, more, edit in ways:
                    step = 3 * n + edit
                    way = (cost + INSERT * n + more, rank, STEPS[step], 16 * origin + step)
                    if best[to] is None or way[:3] < best[to][:3]:
                        best[to] = way
                place = FITS[place]
        least = min(b[0] for b in best if b)
        order = sorted((b[1:3], i) for i, b in enumerate(best) if b)
        rank = {i: r for r, (_, i) in enumerate(order)}
        places = tuple((b[0] - least, rank[i]) if b else None for i, b in enumerate(best))
        return self._state(places), least, bytes(b[3] if b else 0 for b in best)

    def end(self, state: int) -> tuple[int, int]:
        """The place where the cheapest audit ends, and the insertions after it."""
        closing = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
        ways = [(own[0] + INSERT * closing[p], own[1], p) for p, own in enumerate(self.states[state]) if own]
        place = min(ways)[2]
        return place, closing[place]


def traced(back: bytes, place: int) -> tuple[bytes, int]:
    """The steps of the rows whose backpointers (four bytes each) end at a place, and the place before them."""
    out = bytearray(len(back) // 4)
    for i in range(len(out) - 1, -1, -1):
        entry = back[4 * i + place]
        out[i], place = entry & 15, entry >> 4
    return bytes(out), place


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, alive: rows damaged by crc32(`conv_id:turn`) % 20 (nulls: one space): 0 not alive, 1 text emptied,
    2 without [.!?], 3 twice, 4 role user."""
    read = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(read("text"), ".!?", "")).otherwise(read("text"))
    rows = turns.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(read("role")).alias("role"), text.alias("text"), (fate != 0).alias("alive"), F.when(fate == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "time")


def faults(turns: DataFrame) -> DataFrame:
    """The rows with role and text read, and: print (of both), fault (blank, duplicate, truncated, or null), kind (of `Machine`).

    A repeated row of one turn is no duplicate yet here: the stream tells it by the print before.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("print", F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)))
    first = rows.groupBy("conv_id", "print").agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unset"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("of"), F.col("print").alias("of_print"), "first", "unset")
    met = rows.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("print") == F.col("of_print")), "left")
    bare = F.rtrim("text", F.lit(SPACES))
    again = F.col("turn").isNotNull() & (F.col("unset") | (F.col("turn") > F.col("first")))
    fault = F.when(bare == "", "blank").when(again, "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), MUST_DELETE).otherwise(code + F.when(F.col("fault") == "truncated", 4).otherwise(0))
    return met.withColumn("fault", fault).select("conv_id", "turn", "role", "text", "print", "fault", kind.cast("int").alias("kind"))


def _spelt(frame: DataFrame, *names: str) -> DataFrame:
    """Whole numbers as text: pandas would make them floats where some are null."""
    return frame.withColumns({n: F.col(n).cast("string") for n in names})


_TEXTS = ("role", "text", "fault", "edit", "new_role")


def _applied(out: list[tuple], conv, at: int, place: int, step: int, row: tuple | None) -> tuple[int, int]:
    """Append what one step does: inserted rows, then the row. Returns the next order number and place."""
    for _ in range(step // 3):
        place = FITS[place]
        out.append((conv, at, None, "user" if place == USER else "assistant", "", None, "I", "user" if place == USER else "assistant"))
        at += 1
    if row is not None:
        turn, role, text, fault = row
        edit, new = step % 3, None
        if edit == 1:
            place, new = KEPT[role[0]][place], role
        elif edit == 2:
            place = FITS[place]
            new = "user" if place == USER else "assistant"
        out.append((conv, at, turn, role, text, fault, "DKR"[edit], new))
        at += 1
    return at, place


_OUT = ("conv_id", "at", "turn", *_TEXTS)


def _frame(rows: list[tuple], parts: list[tuple]) -> pd.DataFrame:
    """Output rows and parts of backpointers (conv_id, whether it is the last, its number, its bytes)."""
    blank = (None,) * (len(_OUT) - 2)
    rows = [(*r, None, None) for r in rows] + [(conv, last, *blank, number, back) for conv, last, number, back in parts]
    return pd.DataFrame(rows, columns=[*_OUT, "part", "back"], dtype=object)


def repair(turns: DataFrame, most_rows: int = GAP, most_chars: int = 1 << 22) -> DataFrame:
    """What becomes of every row: conv_id, at (order, from 1), turn, role, text, fault, edit (K, R, D; I for an inserted row), new_role (null: deleted).

    Conversations of more rows or characters than given are traced back in parts that lie in the shared folder.
    """
    rows = faults(turns).withColumn("said", F.col("turn").cast("string")).withColumn("conv_id", F.col("conv_id").cast("string"))
    typed = lambda frame: frame.select(*(F.col(c).cast(turns.schema[c].dataType).alias(c) if c in ("conv_id", "turn") else c for c in _OUT))
    out = shape(("conv_id", "string"), ("at", "bigint"), ("turn", "string"), *((c, "string") for c in _TEXTS), ("part", "bigint"), ("back", "binary"))
    own = ["conv_id", "turn", "role", "text"]
    tasks = parallelism(turns.sparkSession)

    def forward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = Machine()
        conv = last = None
        begun = giant = False
        state, at, part, chars = machine.start, 0, 0, 0
        held: list[tuple] = []
        back: list[bytes] = []

        def spilt(final: bool) -> tuple:
            """A part of backpointers; the last one says where the audit ends, in two bytes more."""
            data = b"".join(back)
            if final:
                data += bytes(machine.end(state))
            return conv, int(final), part, data

        def finished(made: list[tuple], spills: list[tuple]) -> None:
            if giant:
                spills.append(spilt(True))
                return
            place, closing = machine.end(state)
            steps, _ = traced(b"".join(back), place)
            n, place = 1, START
            for step, row in zip(steps, held, strict=True):
                n, place = _applied(made, conv, n, place, step, row)
            _applied(made, conv, n, place, 3 * closing, None)

        for frame in frames:
            made: list[tuple] = []
            spills: list[tuple] = []
            for c, turn, role, text, mark, fault, kind in zip(*(frame[x] for x in ("conv_id", "said", "role", "text", "print", "fault", "kind")), strict=True):
                if not begun or c != conv:
                    if begun:
                        finished(made, spills)
                    conv, last, begun, giant = c, None, True, False
                    state, at, part, chars = machine.start, 0, 0, 0
                    held, back = [], []
                if fault != "blank" and mark == last:  # rows of one role and text, not blank, follow each other: the same turn, or a duplicate anyway
                    fault, kind = "duplicate", MUST_DELETE
                last = mark
                state, _, entry = machine.step(state, int(kind))
                back.append(entry)
                if not giant:
                    held.append((turn, role, text, fault))
                    chars += len(text)
                    if len(held) > most_rows or chars > most_chars:
                        giant, held = True, []
                if giant and len(back) >= most_rows:
                    spills.append(spilt(False))
                    back, part = [], part + 1
            yield _frame(made, spills)
        if begun:
            made, spills = [], []
            finished(made, spills)
            yield _frame(made, spills)

    dealt = rows.repartition(tasks, "conv_id").sortWithinPartitions(*own)
    first = written(dealt.mapInPandas(forward, out))
    small = first.where("part is null").select(*_OUT)
    parts = first.where("part is not null").select("conv_id", "part", F.col("at").alias("final"), "back")
    if not parts.limit(1).count():
        return typed(small)

    def backward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = START
        for frame in frames:
            found = []
            for c, part, final, back in zip(frame["conv_id"], frame["part"], frame["final"], frame["back"], strict=True):
                closing = None
                if final:
                    back, (place, closing) = back[:-2], back[-2:]
                steps, place = traced(back, place)
                found.append((c, part, steps, closing))
            yield pd.DataFrame(found, columns=["conv_id", "part", "steps", "closing"], dtype=object)

    steps = parts.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", F.desc("part")).mapInPandas(backward, shape(("conv_id", "string"), ("part", "bigint"), ("steps", "binary"), ("closing", "int")))
    steps = written(steps)
    giants = steps.where("closing is not null").select(F.col("conv_id").alias("of"))
    text = rows.join(giants, F.col("conv_id").eqNullSafe(F.col("of")), "left_semi").select(*own, "said", "print", "fault")
    both = text.select(*own, "said", "print", "fault", F.lit(None).cast("bigint").alias("part"), F.lit(None).cast("binary").alias("steps"), F.lit(None).cast("int").alias("closing"), F.lit(1).alias("after"))
    both = both.unionByName(steps.withColumn("after", F.lit(0)), allowMissingColumns=True)

    def applied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv = last = None
        begun = False
        todo, done, closing, n, place = [], 0, 0, 1, START

        for frame in frames:
            made: list[tuple] = []
            for c, turn, role, text, mark, fault, after, step, end in zip(*(frame[x] for x in ("conv_id", "said", "role", "text", "print", "fault", "after", "steps", "closing")), strict=True):
                if not begun or c != conv:
                    if begun:
                        _applied(made, conv, n, place, 3 * closing, None)
                    conv, last, begun = c, None, True
                    todo, done, closing, n, place = bytearray(), 0, 0, 1, START
                if not after:
                    todo += step
                    closing = closing if end is None or pd.isna(end) else int(end)
                    continue
                if fault != "blank" and mark == last:
                    fault = "duplicate"
                last = mark
                n, place = _applied(made, c, n, place, todo[done], (turn, role, text, fault))
                done += 1
            yield pd.DataFrame(made, columns=list(_OUT), dtype=object)
        if begun:
            made = []
            _applied(made, conv, n, place, 3 * closing, None)
            yield pd.DataFrame(made, columns=list(_OUT), dtype=object)

    again = both.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "after", "part", "turn", "role", "text")
    return typed(small.unionByName(again.mapInPandas(applied, shape(*((f.name, f.dataType) for f in out.fields if f.name in _OUT)))))


def digest(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row per conv_id of `conversations`: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The edits stream past in order; counts and the hash are carried, and the audit's letters.
    """
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = ["bigint"] * 6 + ["string", "string"]

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, begun = None, False
        count, low, high, distinct, turn_before, role_before, cost, audit, text = {}, None, None, 0, None, None, 0, [], hashlib.sha256()
        lines = 0

        def finished() -> tuple:
            gaps = 0 if low is None else high - low + 1 - distinct
            return conv, gaps, *(count.get(x, 0) for x in ("blank", "duplicate", "truncated", "illegal")), cost, "".join(audit), text.hexdigest()

        for frame in frames:
            done = []
            for c, turn, role, said, fault, edit, new in zip(*(frame[x] for x in ("conv_id", "turn", "role", "text", "fault", "edit", "new_role")), strict=True):
                if not begun or c != conv:
                    if begun:
                        done.append(finished())
                    conv, begun = c, True
                    count, low, high, distinct, turn_before, role_before, cost, audit, text, lines = {}, None, None, 0, None, None, 0, [], hashlib.sha256(), 0
                audit.append(edit)
                cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                if new is not None:
                    text.update((("\n" if lines else "") + f"{new}:{said}").encode("utf-8", "replace"))
                    lines += 1
                if edit == "I":
                    continue
                if fault is not None:
                    count[fault] = count.get(fault, 0) + 1
                if role_before is not None and role_before + role[:1] not in ("su", "ua", "au"):
                    count["illegal"] = count.get("illegal", 0) + 1
                role_before = role[:1]
                if turn is not None:
                    low, high = int(turn) if low is None else low, int(turn)
                    distinct += turn != turn_before
                    turn_before = turn
            yield pd.DataFrame(done, columns=names, dtype=object)
        if begun:
            yield pd.DataFrame([finished()], columns=names, dtype=object)

    kind = conversations.schema["conv_id"].dataType
    dealt = _spelt(repaired, "conv_id", "turn").repartition(parallelism(conversations.sparkSession), "conv_id").sortWithinPartitions("conv_id", "at")
    sums = dealt.mapInPandas(stream, shape(("conv_id", "string"), *zip(names[1:], kinds, strict=True))).withColumn("conv_id", F.col("conv_id").cast(kind))
    every = conversations.select(F.col("conv_id").alias("of")).distinct()
    out = every.join(sums, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    zero = {c: F.lit(0) for c in names[1:7]} | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return out.select(F.col("of").alias("conv_id"), *(F.coalesce(c, v.cast(k)).alias(c) for (c, v), k in zip(zero.items(), kinds, strict=True)))
