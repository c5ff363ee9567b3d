"""What the similarity operators share: MinHash signatures, links within candidate groups,
exact Jaccard in blocks, connected components.

Pairs never become rows. A candidate group goes to tasks as blocks of at most `block`
members; a larger group goes as every pair of its blocks, so each task holds two blocks at
most whatever the group's size, and gives a row for each member and a spanning forest of
the links it found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import WordHashes, mix, shingle_hashes, stored, words_of

SHINGLE = 5
_CHUNK = 1 << 16


def seeds(count: int, seed: int) -> np.ndarray:
    """Odd multipliers, one for each hash function."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def signatures(shingles: list[np.ndarray], multipliers: np.ndarray) -> np.ndarray:
    """MinHash values (rows: texts with at least one shingle) as 64-bit numbers."""
    out = np.empty((len(shingles), len(multipliers)), np.uint64)
    first = 0
    while first < len(shingles):  # whole texts, about _CHUNK shingles at a time, to stay in cache
        last, size = first, 0
        while last < len(shingles) and (size == 0 or size + len(shingles[last]) <= _CHUNK):
            size += len(shingles[last])
            last += 1
        values = np.concatenate(shingles[first:last])
        starts = np.cumsum([0] + [len(s) for s in shingles[first : last - 1]])
        for j, a in enumerate(multipliers):
            out[first:last, j] = np.minimum.reduceat(values * a, starts)
        first = last
    return out


def shingle_set(text: str, hashes: WordHashes, width: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(hashes.of(words_of(text)), width))


def jaccard_blocks(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Matrix of whether two sorted shingle sets have a Jaccard similarity of `threshold` or more.

    Shared shingles are counted by matrix products over slices of the sets' union, so memory
    stays bounded however long the texts are.
    """
    sizes_l, sizes_r = (np.array([len(x) for x in side], float) for side in (left, right))
    universe = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    shared = np.zeros((len(left), len(right)), np.float64)
    for start in range(0, len(universe), 4096):
        part = universe[start : start + 4096]
        masks = []
        for side in (left, right):
            mask = np.zeros((len(side), len(part)), np.float32)
            for i, values in enumerate(side):
                lo, hi = np.searchsorted(values, (part[0], part[-1]), "left")
                own = values[lo : hi + 1]
                at = np.searchsorted(part, own)
                at = at[(at < len(part)) & (part[np.minimum(at, len(part) - 1)] == own)]
                mask[i, at] = 1
            masks.append(mask)
        shared += masks[0] @ masks[1].T
    union = sizes_l[:, None] + sizes_r[None, :] - shared
    return shared >= threshold * union - 1e-9


def forest(links: np.ndarray, rows: list, columns: list, joined: Iterable[tuple] = ()) -> list[tuple]:
    """A spanning forest of the graph with these links between row and column members; less what `joined` pairs already link."""
    parent: dict = {x: x for x in (*rows, *columns)}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in joined:
        a, b = root(x), root(y)
        parent[max(a, b)] = min(a, b)
    out = []
    for i, j in zip(*np.nonzero(links), strict=True):
        a, b = root(rows[i]), root(columns[j])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((max(a, b), min(a, b)))
    return out


def in_blocks(members: DataFrame, payload: DataFrame, block: int) -> DataFrame:
    """Tasks of the groups in `members` (group: long, id: long) that have two members or more.

    Rows (group, a, b, side, alone) with the columns of `payload` (id, ...): a member of a
    group with n members goes to n/block tasks, one for each pair of its block with another;
    `side` is 0 for a task's rows and 1 for its columns, `alone` says that both are one block.
    Only numbers are shuffled until groups of one are out.
    """
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = members.join(sizes, "group")
    count = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("id"), count.cast("long")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda other: F.struct(F.least(own, other).alias("a"), F.greatest(own, other).alias("b"), F.when(own <= other, 0).otherwise(1).alias("side")),
    )
    tasks = joined.select("group", "id", F.explode(pairs).alias("p")).select("group", "id", "p.*", (F.col("p.a") == F.col("p.b")).alias("alone"))
    return tasks.join(payload, "id")


def in_tasks(tasks: DataFrame, columns: list[str], work: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """Bring each task's rows together and give their columns, as lists, to `work`.

    Tasks are many and small, so a partition is read as one stream sorted by task instead of
    one call of Spark's for each group; a task never holds more than two blocks.
    """
    order = ["group", "a", "b"]
    names = [f.split()[0] for f in schema.split(", ")]

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            ids = held["task"].to_numpy()
            ends = np.flatnonzero(ids[1:] != ids[:-1]) + 1
            if not len(ends):
                continue
            yield done(held.iloc[: ends[-1]], ends[:-1])
            held = held.iloc[ends[-1] :].reset_index(drop=True)
        if held is not None and len(held):
            yield done(held, np.array([], int))

    def done(frame: pd.DataFrame, inner: np.ndarray) -> pd.DataFrame:
        lists = [frame[c].tolist() for c in ("side", "alone", *columns)]
        out, edges = [], [0, *inner.tolist(), len(frame)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            side, alone, *values = (x[start:end] for x in lists)
            if alone[0]:
                left = right = values
            else:
                left, right = ([[v for v, s in zip(x, side, strict=True) if s == k] for x in values] for k in (0, 1))
            if left[0] and right[0]:
                out += work(alone[0], left, right)
        return pd.DataFrame(out, columns=names)

    dealt = tasks.repartition(*order).sortWithinPartitions(*order)
    kept = dealt.select(F.xxhash64(*order).alias("task"), "side", "alone", *columns)
    return kept.mapInPandas(stream, schema)


def link_rows(links: np.ndarray, alone: bool, left: list, right: list) -> list[tuple]:
    """(node, other, links): edges of a spanning forest have `other`; rows without it count a
    node's links in this task."""
    half = np.triu(links, 1) if alone else links
    out = [(a, b, 0) for a, b in forest(half, left, right)]
    out += [(x, None, int(n)) for x, n in zip(left, half.sum(1), strict=True) if n]
    out += [(x, None, int(n)) for x, n in zip(right, half.sum(0), strict=True) if n]
    return out


def verified_links(clusters: DataFrame, texts: DataFrame, threshold: float, width: int, block: int) -> DataFrame:
    """Exact Jaccard of the shingle sets of all `texts` (node, text) within each component of
    `clusters` (node, component): rows (node, other, links)."""

    def work(alone: bool, left: list, right: list) -> list[tuple]:
        hashes = WordHashes()
        sets = [shingle_set(t, hashes, width) for t in left[1]]
        others = sets if alone else [shingle_set(t, hashes, width) for t in right[1]]
        return link_rows(jaccard_blocks(sets, others, threshold), alone, left[0], right[0])

    members = clusters.select(F.xxhash64("component").alias("group"), F.xxhash64("node").alias("id"))
    tasks = in_blocks(members, texts.select(F.xxhash64("node").alias("id"), "node", "text"), block)
    return in_tasks(tasks, ["node", "text"], work, "node string, other string, links long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of `edges` (node, other: strings).

    Each round gives every node the smallest of its neighbours and itself, contracts the
    graph by that, and stops when no edge is left. Node names are hashes, so a round leaves
    a fraction of the edges, whatever the graph's shape. A round's tables are stored.
    """
    left = stored(edges.select(F.col("node").alias("a"), F.col("other").alias("b")).where("a != b").distinct(), "edges")
    assigned = None
    for _ in range(most_rounds):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "least")
        if assigned is None:
            assigned = least.select(F.col("a").alias("node"), F.col("low").alias("component"))
        else:
            step = least.select(F.col("a").alias("component"), "low")
            assigned = stored(
                assigned.join(step, "component", "left").select("node", F.coalesce("low", "component").alias("component")), "assigned"
            )
        ends = left.join(least.withColumnRenamed("low", "x"), "a").select("b", "x")
        ends = ends.join(least.select(F.col("a").alias("b"), F.col("low").alias("y")), "b").where("x != y")
        left = stored(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        if left.isEmpty():
            return assigned
    raise RuntimeError("components did not settle")
