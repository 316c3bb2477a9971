"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation, and it ends with the assistant. Each
turn of a conversation is kept, relabelled, merged into the turn before it, and empty turns may be put in; the cheapest sequence
of such steps that the automaton of legal turns accepts is chosen by dynamic programming over its states, and rendered.

A turn's possible steps form a small table of costs from state to state, and such tables compose. Conversations are therefore
cut where range partitions end: each part of a conversation is summed up as one table, the few parts of a conversation that goes
over several partitions are solved in order, and every part is then traced on its own. A conversation of any length is dealt over
many tasks, and no row holds more than one turn.

The result has a row per input turn, in order; the ``rendered`` texts of a conversation, one after the other, are its chat.

* turns are ordered by turn, nulls first, then by a hash of role and text; ``position`` tells the order; equal rows are turns of their own; a null conv_id is one conversation;
* a null text counts as empty; a role that is null or unknown (after ``ALIASES``) is relabelled at the lower ``unknown`` cost;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.session import written_once

from .common import bounded_broadcast

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
FAR = 1 << 40
OPEN, CLOSE, JOINT = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"
#: For each state, the turn that may follow without another one between, and the turn to put in otherwise.
_FOLLOWS = {(START, SYSTEM): (), (START, USER): (), (SYSTEM, USER): (), (USER, ASSISTANT): (), (ASSISTANT, USER): ()}
_FOLLOWS |= {(START, ASSISTANT): (USER,), (SYSTEM, ASSISTANT): (USER,), (USER, USER): (ASSISTANT,), (ASSISTANT, ASSISTANT): (USER,)}


class Costs(NamedTuple):
    """Giving a turn to another speaker costs more than a merge and an empty turn together."""

    merge: int = 2
    insert: int = 3
    relabel: int = 6
    unknown: int = 1


class Step(NamedTuple):
    cost: int
    merged: bool
    inserted: tuple[int, ...]


def role_of(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return NAMES.index(name) if name in NAMES[1:] else START


def steps(role: int, costs: Costs) -> dict[tuple[int, int], Step]:
    """The cheapest way to take a turn of a role from each state to each state; a merge wins ties with an insertion."""
    out = {}
    for after in (SYSTEM, USER, ASSISTANT):
        label = 0 if role == after else costs.unknown if role == START else costs.relabel
        for before in range(4):
            ways = []
            if before == after:
                ways.append(Step(costs.merge + label, True, ()))
            if (before, after) in _FOLLOWS:
                put = _FOLLOWS[before, after]
                ways.append(Step(costs.insert * len(put) + label, False, put))
            if ways:
                out[before, after] = min(ways, key=lambda w: (w.cost, not w.merged))
    return out


def closing(state: int, costs: Costs) -> tuple[int, tuple[int, ...]]:
    """Cost and turns to put in so that a conversation may end in a state."""
    put = {START: (), ASSISTANT: (), USER: (ASSISTANT,), SYSTEM: (USER, ASSISTANT)}[state]
    return costs.insert * len(put), put


def table(roles: list[int], costs: Costs) -> list[list[int]]:
    """Least cost from each state to each state over some turns."""
    known = [steps(r, costs) for r in range(4)]
    best = [[0 if a == b else FAR for b in range(4)] for a in range(4)]
    for role in roles:
        row = known[role]
        best = [[min((b[p] + s.cost for (p, q), s in row.items() if q == after), default=FAR) for after in range(4)] for b in best]
    return best


def trace(roles: list[int], enter: int, leave: int | None, costs: Costs) -> list[tuple[int, Step]]:
    """(state after it, step) of each turn on the cheapest way from ``enter`` to ``leave`` (None: to an end).

    Ties go to the smaller state.
    """
    known = [steps(r, costs) for r in range(4)]
    best = [0 if s == enter else FAR for s in range(4)]
    back: list[list[int]] = []
    for role in roles:
        after, came = [FAR] * 4, [0] * 4
        for (p, q), s in sorted(known[role].items()):
            if best[p] + s.cost < after[q]:
                after[q], came[q] = best[p] + s.cost, p
        best = after
        back.append(came)
    if leave is None:
        leave = min(range(4), key=lambda s: best[s] + closing(s, costs)[0])
    out = []
    for role, came in zip(reversed(roles), reversed(back), strict=True):
        out.append((leave, known[role][came[leave], leave]))
        leave = came[leave]
    return out[::-1]


def solve(tables: list[list[list[int]]], costs: Costs) -> list[tuple[int, int]]:
    """(state before, state after) of each part of a conversation."""
    best, back = [0, FAR, FAR, FAR], []
    for t in tables:
        came = [min(range(4), key=lambda p, q=q: best[p] + t[p][q]) for q in range(4)]
        best = [best[came[q]] + t[came[q]][q] for q in range(4)]
        back.append(came)
    state = min(range(4), key=lambda s: best[s] + closing(s, costs)[0])
    out = []
    for came in reversed(back):
        out.append((came[state], state))
        state = came[state]
    return out[::-1]


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        places = pa.array(range(place, place + len(batch)), pa.int64())
        place += len(batch)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(batch), pa.int32()), places], names=[*batch.schema.names, "part", "place"]
        )


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows with equal (part, conv_id), which follow each other; a run is a part of a conversation in one partition."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if run and (row["part"], row["conv_id"]) != (run[0]["part"], run[0]["conv_id"]):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _summed(batches: Iterable[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches):
        flat = [c for row in table([role_of(r["role"]) for r in run], costs) for c in row]
        arrays = [pa.array([run[0]["conv_id"]], pa.int64()), pa.array([run[0]["part"]], pa.int32()), pa.array([len(run)], pa.int64())]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([flat], pa.list_(pa.int64()))], names=["conv_id", "part", "turns", "costs"])


def _solved(batches: Iterable[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, part): at most two parts of each partition are here."""
    rows = [r for b in batches for r in b.to_pylist()]
    out, i = [], 0
    while i < len(rows):
        j = next((k for k in range(i, len(rows)) if rows[k]["conv_id"] != rows[i]["conv_id"]), len(rows))
        tables = [[r["costs"][4 * s : 4 * s + 4] for s in range(4)] for r in rows[i:j]]
        before = 0
        for k, (r, (enter, leave)) in enumerate(zip(rows[i:j], solve(tables, costs), strict=True)):
            own = {"own_conv": r["conv_id"], "own_part": r["part"], "enter": enter, "leave": leave, "last": k == j - i - 1}
            out.append({**own, "before": before})
            before += r["turns"]
        i = j
    if out:
        kinds = [("own_conv", pa.int64()), ("own_part", pa.int32()), ("enter", pa.int32()), ("leave", pa.int32()), ("last", pa.bool_())]
        kinds.append(("before", pa.int64()))
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))


_OUT = "conv_id long, position long, turn long, role string, repaired_role string, action string, inserted string, cost long, rendered string"
_KINDS = [("conv_id", pa.int64()), ("position", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("repaired_role", pa.string())]
_KINDS += [("action", pa.string()), ("inserted", pa.string()), ("cost", pa.int64()), ("rendered", pa.string())]


def _rendered(batches: Iterable[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    empty = lambda roles: "".join(OPEN.format(NAMES[r]) + CLOSE for r in roles)
    out: list[dict] = []
    for run in _runs(batches):
        state, leave, last = run[0]["enter"] or START, run[0]["leave"], run[0]["last"] is not False
        ways = trace([role_of(r["role"]) for r in run], state, leave, costs)
        for i, (row, (after, step)) in enumerate(zip(run, ways, strict=True)):
            text, cost, put = row["text"] or "", step.cost, [NAMES[r] for r in step.inserted]
            if step.merged:
                shown = JOINT + text
            else:
                shown = (CLOSE if state != START else "") + empty(step.inserted) + OPEN.format(NAMES[after]) + text
            if last and i == len(run) - 1:
                more, turns = closing(after, costs)
                shown, cost, put = shown + CLOSE + empty(turns), cost + more, [*put, *(f"+{NAMES[r]}" for r in turns)]
            action = "merge" if step.merged else "keep" if role_of(row["role"]) == after else "relabel"
            fixed = {"repaired_role": NAMES[after], "action": action, "inserted": " ".join(put), "cost": cost, "rendered": shown}
            at = {"position": row["place"] - run[0]["place"] + (run[0]["before"] or 0)}
            out.append({k: row[k] for k in ("conv_id", "turn", "role")} | at | fixed)
            state = after
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_KINDS))
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_KINDS))


def repair(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """conv_id, position, turn, role, repaired_role, action, inserted, cost and rendered of each turn.

    ``position`` counts a conversation's turns from 0, without gaps and over all its parts, in the order of the chat; ``inserted`` names the empty turns put in before the turn, and with a + those put in after a conversation's last one.
    """
    narrow = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("tie", F.xxhash64("role", "text"))
    order = ["conv_id", "turn", "role", "text"]
    ordered = narrow.repartitionByRange("conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie").select(*order)
    placed = written_once(ordered.mapInArrow(_placed, "conv_id long, turn long, role string, text string, part int, place long"), "turns")

    def runs(df: DataFrame) -> DataFrame:
        return df.repartition("part", "conv_id").sortWithinPartitions("part", "conv_id", "place")

    parts = placed.select("conv_id", "part").distinct()
    long = written_once(parts.groupBy("conv_id").count().where("count > 1").select("conv_id"), "long-conversations")
    at = placed["conv_id"].eqNullSafe(F.col("own"))
    pieces = placed.join(bounded_broadcast(long.select(F.col("conv_id").alias("own"))), at, "left_semi").drop("text")
    sums = runs(pieces).mapInArrow(partial(_summed, costs=costs), "conv_id long, part int, turns long, costs array<long>")
    # A partition starts and ends with a part of a conversation at most: two rows per partition.
    solved = sums.repartition(1).sortWithinPartitions("conv_id", "part").mapInArrow(
        partial(_solved, costs=costs), "own_conv long, own_part int, enter int, leave int, last boolean, before long"
    )
    solved = bounded_broadcast(written_once(solved, "parts"))
    on = placed["conv_id"].eqNullSafe(solved["own_conv"]) & (placed["part"] == solved["own_part"])
    known = placed.join(solved, on, "left").select(*placed.columns, "enter", "leave", "last", "before")
    fixed = runs(known).mapInArrow(partial(_rendered, costs=costs), _OUT)
    return fixed.select(
        "conv_id", "position", "turn", "role", "repaired_role", "action", "inserted", "cost", "rendered"
    )
