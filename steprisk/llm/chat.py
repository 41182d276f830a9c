"""Chat formatting with minimum-cost role repair.

A legal conversation is a path of an automaton: an optional system turn, then user, then assistant, which may be
followed by user or by tool, a tool by the assistant again; it ends after an assistant turn. Every source turn is kept,
relabelled, merged into the turn before it, and empty turns may be put in between, each at a cost; the cheapest
repair is found by dynamic programming over the automaton's states and then rendered.

A turn is a (states x states) matrix of costs, and matrices combine in any grouping (minimum of sums). So a
conversation of any length may be split: keys without texts are range-partitioned by (conversation, turn), each task
sums up the first and the last run of its partition, the driver joins at most two such matrices per partition into
entry and exit states, and each task repairs its own share. Texts are joined to the finished actions only.

Defined results: turns are ordered by ``turn`` (null last), then role, then a hash of the text. Rows equal in
conversation, turn, role and text are one turn. A null or unknown role is relabelled, at a lower cost. Rows without a
conversation id are one conversation. A null text is an empty one. An empty table gives no rows. Markers inside a
text are broken up, so they cannot end a turn. Columns other than these four play no role.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steprisk.session import checkpointed

ROLES = ("system", "user", "assistant", "tool")
START = len(ROLES)  # states 0 to 3: the last turn's role
STATES = len(ROLES) + 1
FOLLOWS = {START: (0, 1), 0: (1,), 1: (2,), 2: (1, 3), 3: (2,)}
FINAL = 2
MERGE, RELABEL, NAME, INSERT = 2, 3, 1, 4  # costs; NAME: give a role to a turn that has none
NEVER = 1 << 40
TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>\n"


def _insertions() -> tuple[np.ndarray, dict[tuple[int, int], tuple[int, ...]]]:
    """Cheapest chains of empty turns between any two states, and their roles."""
    cost = np.full((STATES, STATES), NEVER, dtype=np.int64)
    chain: dict[tuple[int, int], tuple[int, ...]] = {}
    for state in range(STATES):
        cost[state, state], chain[state, state] = 0, ()
        front = [state]
        while front:
            following = []
            for at in front:
                for role in FOLLOWS[at]:
                    if (state, role) not in chain:
                        chain[state, role] = chain[state, at] + (role,)
                        cost[state, role] = cost[state, at] + INSERT
                        following.append(role)
            front = following
    return cost, chain


INSERT_COST, INSERT_CHAIN = _insertions()


def _turn_table(role: int | None) -> tuple[np.ndarray, dict[tuple[int, int], tuple[tuple[int, ...], str]]]:
    """Cost of every state change that one source turn of ``role`` can make, and how it is made."""
    cost = np.full((STATES, STATES), NEVER, dtype=np.int64)
    way: dict[tuple[int, int], tuple[tuple[int, ...], str]] = {}
    for state in range(STATES):
        for target in range(len(ROLES)):
            renamed = 0 if target == role else (NAME if role is None else RELABEL)
            options = [
                (INSERT_COST[state, at] + renamed, INSERT_CHAIN[state, at], "relabel" if renamed else "keep")
                for at in range(STATES)
                if target in FOLLOWS[at] and INSERT_COST[state, at] < NEVER
            ]
            if state == target:
                options.append((MERGE + renamed, (), "relabel and merge" if renamed else "merge"))
            best = min(options, key=lambda option: option[0], default=None)
            if best:
                cost[state, target], way[state, target] = best[0], best[1:]
    return cost, way


TABLES = {role: _turn_table(role) for role in (*range(len(ROLES)), None)}


def role_number(role: str | None) -> int | None:
    return ROLES.index(role) if role in ROLES else None


def combined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Costs of one stretch followed by another."""
    return np.minimum((first[:, :, None] + second[None, :, :]).min(axis=1), NEVER)


def repair(roles: list[int | None], entry: int = START, leave: int | None = None) -> tuple[int, list[tuple[tuple[int, ...], str, int]], tuple[int, ...]]:
    """Cost, per turn (roles inserted before it, action, its role), roles inserted at the end.

    ``leave``: the state to end in, if the conversation goes on elsewhere; else it ends here.
    """
    costs = np.full(STATES, NEVER, dtype=np.int64)
    costs[entry] = 0
    came = []
    for role in roles:
        options = costs[:, None] + TABLES[role][0]
        came.append(options.argmin(axis=0))
        costs = np.minimum(options.min(axis=0), NEVER)
    end = costs + INSERT_COST[:, FINAL]
    state = int(end.argmin()) if leave is None else leave
    total, tail = (int(end[state]), INSERT_CHAIN[state, FINAL]) if leave is None else (int(costs[state]), ())
    steps = []
    for role, origin in zip(reversed(roles), reversed(came)):
        before = int(origin[state])
        inserted, action = TABLES[role][1][before, state]
        steps.append((inserted, action, state))
        state = before
    return total, steps[::-1], tail


# --- over partitions -------------------------------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Consecutive rows (conversation, turn, role, two key hashes) of one conversation."""
    conversation, held, begun = None, [], False
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if begun and row[0] != conversation:
                yield conversation, held
                held = []
            conversation, begun = row[0], True
            held.append(row)
    if begun:
        yield conversation, held


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost matrices of a partition's first and last run."""
    part, ends = TaskContext.get().partitionId(), {}
    for number, (conversation, rows) in enumerate(_runs(batches)):
        ends[min(number, 1)] = (number, conversation, rows)
    for number, conversation, rows in ends.values():
        matrix = np.where(np.eye(STATES, dtype=bool), 0, NEVER)
        for row in rows:
            matrix = combined(matrix, TABLES[role_number(row[2])][0])
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "run": number, "conv_id": conversation, "turns": len(rows), "matrix": matrix.tobytes()}],
            schema=_SUMMARY,
        )


_SUMMARY = pa.schema(
    [("part", pa.int64()), ("run", pa.int64()), ("conv_id", pa.int64()), ("turns", pa.int64()), ("matrix", pa.binary())]
)


def boundary_states(summaries: list) -> dict[tuple[int, int], tuple[int, int | None, int]]:
    """(partition, run) -> entry state, exit state (None: the conversation ends), turns before, for split conversations."""
    chains: list[list] = []
    previous = None
    for row in sorted(summaries, key=lambda row: (row["part"], row["run"])):
        # A conversation goes on from the last run of one partition in the first run of the next that has rows.
        if previous is not None and row["run"] == 0 and row["conv_id"] == previous["conv_id"]:
            chains[-1].append(row)
        else:
            chains.append([row])
        previous = row
    states = {}
    for chain in chains:
        if len(chain) < 2:
            continue
        costs = np.full(STATES, NEVER, dtype=np.int64)
        costs[START] = 0
        came = []
        for row in chain:
            options = costs[:, None] + np.frombuffer(row["matrix"], np.int64).reshape(STATES, STATES)
            came.append(options.argmin(axis=0))
            costs = np.minimum(options.min(axis=0), NEVER)
        state, goes_on, before = int((costs + INSERT_COST[:, FINAL]).argmin()), False, sum(row["turns"] for row in chain)
        for row, origin in zip(reversed(chain), reversed(came)):
            before -= row["turns"]
            entry = int(origin[state])
            states[row["part"], row["run"]] = (entry, state if goes_on else None, before)
            state, goes_on = entry, True
    return states


_ACTIONS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("place", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("action", pa.string()),
        ("key", pa.int64()),
        ("second_key", pa.int64()),
        ("first", pa.bool_()),
        ("last", pa.bool_()),
    ]
)
_ROWS_AT_ONCE = 4096


def _repaired(states: dict[tuple[int, int], tuple[int, int | None, int]]):
    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ACTIONS)], schema=_ACTIONS)

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), []
        for number, (conversation, rows) in enumerate(_runs(batches)):
            entry, leave, before = states.get((part, number), (START, None, 0))
            _, steps, tail = repair([role_number(row[2]) for row in rows], entry, leave)
            pieces: list[tuple] = []  # place, turn, role, action, key, second key
            for place, (row, (inserted, action, role)) in enumerate(zip(rows, steps), before):
                pieces += [(place * STATES + i, None, ROLES[r], "insert", None, None) for i, r in enumerate(inserted)]
                pieces.append((place * STATES + STATES - 1, row[1], ROLES[role], action, row[3], row[4]))
            end = (before + len(rows)) * STATES
            pieces += [(end + i, None, ROLES[r], "insert", None, None) for i, r in enumerate(tail)]
            for at, piece in enumerate(pieces):
                held.append(
                    (conversation, *piece, before == 0 and at == 0, leave is None and at == len(pieces) - 1)
                )
                if len(held) >= _ROWS_AT_ONCE:
                    yield as_batch(held)
                    held = []
        if held:
            yield as_batch(held)

    return repaired


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (orders the pieces), ``turn`` (null if inserted), ``role``, ``action``, ``rendered``.

    A conversation's pieces, joined in order of ``place``, are its rendered text.
    """
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").withColumns(
        {
            "key": F.xxhash64("conv_id", "turn", "role", F.col("text").isNull(), "text"),
            "second_key": F.xxhash64(F.lit(1), "conv_id", "turn", "role", F.col("text").isNull(), "text"),
        }
    )
    keys = ["conv_id", "turn", "role", "key", "second_key"]
    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("key"), F.col("second_key")]
    slim = checkpointed(rows.select(*keys).distinct().repartitionByRange(*order).sortWithinPartitions(*order))
    summaries = slim.mapInArrow(_summed, "part long, run long, conv_id long, turns long, matrix binary")
    states = boundary_states(summaries.collect())  # at most two rows per partition
    actions = slim.mapInArrow(
        _repaired(states),
        "conv_id long, place long, turn long, role string, action string, key long, second_key long, first boolean, "
        "last boolean",
    )
    texts = rows.groupBy("key", "second_key").agg(F.first("text").alias("text"))
    inserted = actions.where(F.col("key").isNull()).withColumn("text", F.lit(""))
    sourced = actions.where(F.col("key").isNotNull()).join(texts, ["key", "second_key"])
    safe = F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|(im_start|im_end)\|>", "<| $1 |>")
    merged = F.col("action").endswith("merge")
    opening = F.concat(F.when(F.col("first"), "").otherwise(TURN_CLOSE), F.lit(TURN_OPEN), F.col("role"), F.lit("\n"))
    return sourced.unionByName(inserted).select(
        "conv_id",
        "place",
        "turn",
        "role",
        "action",
        F.concat(F.when(merged, "\n\n").otherwise(opening), safe, F.when(F.col("last"), TURN_CLOSE).otherwise("")).alias("rendered"),
    )


def op5_chat_format(turns: DataFrame) -> DataFrame:
    return format_chats(turns)
