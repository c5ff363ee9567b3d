"""Chat formatting with minimum-cost role repair.

A legal conversation is read by an automaton: an optional system turn first, then user and
assistant turns in alternation from a user turn to an assistant turn. For each turn a
dynamic program chooses to keep its role, to relabel it, or to merge it into the turn before
it, and where to insert empty turns, at the least total cost. The repaired sequence is
rendered as text.

The program runs over (min, +) matrices of the automaton's states, which compose. Turns are
cut into segments of `segment` turn numbers; each gives its matrix, the few matrices of a
conversation are folded in order, and each segment is then traced back on its own between
the states that the fold has fixed. So a conversation of any length is spread over tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import fresh, stored, text_of

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
MERGE_COST, SAME_MERGE_COST, RELABEL_COST, INSERT_COST = 2, 1, 3, 4
_BIG = 1 << 40
#: Legal next turns of each state.
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def role_number(role: str | None) -> int:
    """State that a turn's role leads to; an unknown role has none (0) and must be relabelled."""
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else 0


def inserts() -> tuple[np.ndarray, dict[tuple[int, int], tuple[int, ...]]]:
    """Least cost of going from a state to another by empty turns, and those turns."""
    cost = np.full((STATES, STATES), _BIG)
    path: dict[tuple[int, int], tuple[int, ...]] = {}
    for first in range(STATES):
        cost[first, first], path[first, first] = 0, ()
        edge = [first]
        while edge:
            state = edge.pop(0)
            for to in _NEXT[state]:
                if cost[first, state] + INSERT_COST < cost[first, to]:
                    cost[first, to] = cost[first, state] + INSERT_COST
                    path[first, to] = (*path[first, state], to)
                    edge.append(to)
    return cost, path


_INSERT, _PATH = inserts()


def choices(role: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, action) for one turn, without insertions."""
    out = []
    for state in range(STATES):
        for to in _NEXT[state]:
            out.append((state, to, 0 if to == role else RELABEL_COST, "keep" if to == role else "relabel"))
        if state != START:  # its text joins the turn before
            out.append((state, state, SAME_MERGE_COST if state == role else MERGE_COST, "merge"))
    return out


_STEPS = [choices(r) for r in range(len(ROLES) + 1)]


def turn_matrix(role: int) -> np.ndarray:
    """Least cost of reading a turn from each state to each, with empty turns put in before it."""
    step = np.full((STATES, STATES), _BIG)
    for state, to, cost, _ in _STEPS[role]:
        step[state, to] = min(step[state, to], cost)
    return product(_INSERT, step)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), _BIG)


_TURN = [turn_matrix(r) for r in range(len(ROLES) + 1)]


def segment_matrix(roles: list[int]) -> np.ndarray:
    out = np.where(np.eye(STATES, dtype=bool), 0, _BIG)
    for role in roles:
        out = product(out, _TURN[role])
    return out


def trace(roles: list[int], start: int, end: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """(state after, action, empty turns before) of each turn on a least-cost way from `start` to
    `end`. Of equal ways it takes the one that keeps, then relabels, then merges, at the last
    turn that they differ in."""
    best = [np.where(np.arange(STATES) == start, 0, _BIG)]
    for role in roles:
        best.append(np.minimum((best[-1][:, None] + _TURN[role]).min(0), _BIG))
    out, state = [], end
    rank = {"keep": 0, "relabel": 1, "merge": 2}
    for i in range(len(roles) - 1, -1, -1):
        options = []
        for before in range(STATES):
            for middle, to, cost, action in _STEPS[roles[i]]:
                total = best[i][before] + _INSERT[before, middle] + cost
                if to == state and total == best[i + 1][state] and total < _BIG:
                    options.append((rank[action], len(_PATH[before, middle]), before, middle, action))
        _, _, before, middle, action = min(options)
        out.append((state, action, _PATH[before, middle]))
        state = before
    return out[::-1]


def ended(cost: np.ndarray) -> int:
    """The state that the turns should lead to, so that the way to a legal end is the shortest."""
    return int((cost + _INSERT[:, ASSISTANT]).argmin())


def repaired(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = 512
) -> DataFrame:
    """Rows (conversation, segment, seq, role, text, action, cost): the repaired turns. `seq`
    numbers them within a segment; merged texts are joined by a line end; `cost` is the
    conversation's. Empty turns have the action `insert`.

    A null text is empty, a null or unknown role must be relabelled or merged, null turn
    numbers come last; turns with one number are read by role, then text. Null conversations
    are one conversation; repeated rows are turns of their own; an empty table gives an
    empty result; other columns are left out.
    """
    turns = df.select(
        F.col(conversation).alias("conv"),
        F.coalesce(F.floor(F.col(turn) / segment), F.lit(1 << 40)).cast("long").alias("segment"),
        F.coalesce(F.col(turn).cast("double"), F.lit(float("inf"))).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        text_of(text).alias("text"),
    )
    turns = stored(turns.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "turn", "role", "text"), "turns")
    kind = turns.schema["conv"].dataType.simpleString()

    def groups(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
        """(conv, segment, lists of the columns) of each run in sorted frames."""
        name, held = None, [[] for _ in columns]
        for frame in frames:
            convs = [None if pd.isna(x) else x for x in frame["conv"]]
            for at, *values in zip(zip(convs, frame["segment"], strict=True), *(frame[c] for c in columns), strict=True):
                if at != name and name is not None:
                    yield *name, held
                    held = [[] for _ in columns]
                name = at
                for part, value in zip(held, values, strict=True):
                    part.append(value)
        if name is not None:
            yield *name, held

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for conv, number, (roles,) in groups(frames, ["role"]):
            out.append((conv, number, segment_matrix([role_number(r) for r in roles]).ravel().tolist()))
            if len(out) == 2000:
                yield pd.DataFrame(out, columns=["conv", "segment", "matrix"])
                out = []
        yield pd.DataFrame(out, columns=["conv", "segment", "matrix"])

    def fold(mats: list[np.ndarray]) -> list[tuple]:
        """(start, end, last, cost) of each segment of one conversation, from its matrices in order."""
        at = [np.where(np.arange(STATES) == START, 0, _BIG)]
        for m in mats:
            at.append(np.minimum((at[-1][:, None] + m).min(0), _BIG))
        state = ended(at[-1])
        cost = int(at[-1][state] + _INSERT[state, ASSISTANT])
        ways = []
        for i in range(len(mats) - 1, -1, -1):
            before = int((at[i] + mats[i][:, state]).argmin())
            ways.append((before, state, i == len(mats) - 1, cost))
            state = before
        return ways[::-1]

    def folds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv", "segment", "start", "end", "last", "cost"]
        rows: list[tuple] = []
        for conv, run in itertools.groupby(groups(frames, ["matrix"]), key=lambda x: x[0]):
            parts = [(number, np.asarray(matrix[0]).reshape(STATES, STATES)) for _, number, (matrix,) in run]
            rows += [(conv, number, *way) for (number, _), way in zip(parts, fold([m for _, m in parts]), strict=True)]
            if len(rows) >= 5000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)

    # the stored files are sorted runs, but a file may be split: the runs are brought together again
    order = ["conv", "segment", "turn", "role", "text"]
    again = turns.repartition("conv", "segment").sortWithinPartitions(*order)
    folded = again.select("conv", "segment", "role").mapInPandas(matrices, f"conv {kind}, segment long, matrix array<bigint>")
    together = folded.repartition("conv").sortWithinPartitions("conv", "segment")
    ways = together.mapInPandas(folds, f"conv {kind}, segment long, start int, end int, last boolean, cost long")
    ways = ways.withColumnsRenamed({"conv": "c", "segment": "s"})
    joined = turns.join(ways, F.col("conv").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")))
    joined = joined.repartition("conv", "segment").sortWithinPartitions(*order)

    def repair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv", "segment", "seq", "role", "text", "action", "cost"]
        rows: list[tuple] = []
        for conv, number, (roles, texts, starts, ends, lasts, costs) in groups(frames, ["role", "text", "start", "end", "last", "cost"]):
            out: list[list] = []
            numbers = [role_number(r) for r in roles]
            for value, (state, action, empty) in zip(texts, trace(numbers, starts[0], ends[0]), strict=True):
                out += [[ROLES[s - 1], "", "insert"] for s in empty]
                if action == "merge" and out:
                    out[-1][1] = "\n".join(x for x in (out[-1][1], value) if x)
                else:  # a merge into a turn of the segment before stands first, and is joined when rendered
                    out.append([ROLES[state - 1], value, action])
            if lasts[0]:
                out += [[ROLES[s - 1], "", "insert"] for s in _PATH[ends[0], ASSISTANT]]
            rows += [(conv, number, i, *x, costs[0]) for i, x in enumerate(out)]
            if len(rows) >= 5000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)

    done = joined.mapInPandas(repair, f"conv {kind}, segment long, seq int, role string, text string, action string, cost long")
    return done.withColumnRenamed("conv", fresh(done.drop("conv"), conversation))


def rendered(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row for each conversation: n_turns, n_inserted, n_relabelled, cost and the text, each
    turn as `<|role|>`, a line end, its text and a line end."""
    joins = F.col("action") == "merge"
    piece = F.when(joins, F.concat(F.col("text"), F.lit("\n"))).otherwise(
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    )
    out = turns.groupBy(conversation).agg(
        F.sum((~joins).cast("long")).alias("n_turns"),
        F.sum((F.col("action") == "insert").cast("long")).alias("n_inserted"),
        F.sum((F.col("action") == "relabel").cast("long")).alias("n_relabelled"),
        F.max("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("segment", "seq", piece.alias("piece")))).alias("pieces"),
    )
    return out.withColumn("text", F.array_join(F.transform("pieces", lambda x: x["piece"]), "")).drop("pieces")
