"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

Texts with equal bytes are one class. Each class has a signature of MinHash values of its
five-word shingles, cut into trees of prefixes. A pair of similarity s shares a prefix of
`depth` values in one tree or more with probability p = 1 - (1 - s^depth)^trees. Depth and
the number of trees are chosen so that p reaches the target recall for a pair at the threshold
itself, so whether a pair is met does not depend on what else is in the corpus. Under a
prefix, signatures are compared and classes that look alike are linked.

The linked classes form clusters. Each class's text goes to its cluster once, and within it
every pair is checked exactly, in blocks. The result has no row for a pair: each document
gets its class (components of the verified links) and its number of links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import WordHashes, fresh, mix, stored, text_of
from floorlens.llm.similar import SHINGLE, components, in_blocks, in_tasks, seeds, shingle_set, signatures, verified_links
from floorlens.llm.similar import forest as spanning

#: Longest prefixes are taken that need no more trees than this; signatures have so many values at least.
MOST_TREES = 18
LEAST_VALUES = 144


def tuned_forest(threshold: float, recall: float) -> tuple[int, int]:
    """(trees, depth) of the longest prefix that reaches the recall at the threshold with
    MOST_TREES trees; a prefix of one value takes as many trees as it needs."""
    if threshold >= 1 or recall >= 1:
        raise ValueError("threshold and recall must be below 1")
    for depth in range(12, 0, -1):
        trees = math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))
        if trees <= MOST_TREES or depth == 1:
            return trees, depth


def signed(df: DataFrame, key: str, text: str, width: int, values: int, seed: int) -> DataFrame:
    """Rows (key, node, signature): `node` is the text's fingerprint; a text without words has
    no signature. A signature keeps eight bits of each MinHash value."""
    multipliers = seeds(values, seed)

    def sign(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        for texts in frames:
            sets = [shingle_set(t, hashes, width) for t in texts]
            full = [s for s in sets if len(s)]
            bits = iter((mix(signatures(full, multipliers)) & np.uint64(255)).astype(np.uint8)) if full else iter(())
            yield pd.Series([next(bits).tobytes() if len(s) else None for s in sets], dtype=object)

    return df.select(
        F.col(key).alias("key"), F.md5(text_of(text)).alias("node"), F.pandas_udf(sign, "binary")(text_of(text)).alias("signature")
    )


def likely_links(classes: DataFrame, trees: int, depth: int, least: float, block: int) -> DataFrame:
    """Rows (node, other): classes that share a prefix in some tree and whose signatures agree in
    a share of `least` or more, as a spanning forest of each task."""
    ids = classes.select(F.xxhash64("node").alias("id"), "node", "signature")
    prefixes = [F.xxhash64(F.lit(t), F.substring("signature", t * depth + 1, depth)) for t in range(trees)]
    members = ids.select(F.explode(F.array(*prefixes)).alias("group"), "id")

    def work(alone: bool, left: list, right: list) -> list[tuple]:
        a, b = (np.frombuffer(b"".join(x[1]), np.uint8).reshape(len(x[1]), -1) for x in (left, right))
        links = np.stack([(row == b).mean(1) >= least for row in a])
        return spanning(np.triu(links, 1) if alone else links, left[0], right[0])

    return in_tasks(in_blocks(members, ids, block), ["node", "signature"], work, "node string, other string")


def grouped(
    df: DataFrame, key: str, text: str, threshold: float, width: int, recall: float, block: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Rows (key, node) of `df`, and for each text (node, rep, n_copies, class_id, kept, n_links):
    `kept` is the text of its group with the least key, by which one document can be chosen."""
    trees, depth = tuned_forest(threshold, recall)
    values = max(trees * depth, LEAST_VALUES)
    rows = stored(signed(df, key, text, width, values, seed), "signed")
    classes = stored(
        rows.groupBy("node").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n_copies"), F.max("signature").alias("signature")),
        "classes",
    )
    signable = classes.where("signature IS NOT NULL").select("node", "signature")
    # the share of equal values stays within 4.5 standard deviations of the similarity
    margin = 4.5 * math.sqrt(threshold * (1 - threshold) / values)
    clusters = components(stored(likely_links(signable, trees, depth, threshold - margin, block), "likely"))
    chosen = clusters.join(classes.select("node", "rep"), "node")
    texts = df.select(F.md5(text_of(text)).alias("node"), F.col(key).alias("key"), text_of(text).alias("text"))
    same = (texts["node"] == chosen["node"]) & texts["key"].eqNullSafe(chosen["rep"])
    members = texts.join(chosen, same).select(texts["node"], texts["text"]).dropDuplicates(["node"])
    links = stored(verified_links(clusters, members, threshold, width, block), "links")
    counts = links.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("n_links"))
    groups = components(links.where("other IS NOT NULL").select("node", "other")).join(classes.select("node", "rep"), "node")
    lead = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node"))["node"]
    least = groups.groupBy("component").agg(F.min("rep").alias("class_id"), lead.alias("kept"))
    known = groups.join(least, "component").select("node", "class_id", "kept").join(counts, "node", "left")
    full = classes.select("node", "rep", "n_copies").join(known, "node", "left")
    return rows.select("key", "node"), full.select(
        "node",
        "rep",
        "n_copies",
        F.coalesce("class_id", "rep").alias("class_id"),
        F.coalesce("kept", "node").alias("kept"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def joined(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    width: int = SHINGLE,
    recall: float = 0.999,
    block: int = 128,
    seed: int = 1,
) -> DataFrame:
    """One row for each row of `df`: key, text_class (the least key with an equal text),
    class_id (the least key of the group), n_copies (rows with an equal text, itself
    included), n_links (other texts with a Jaccard similarity of `threshold` or more).

    A text of fewer words than a shingle is one shingle. A null text is empty; texts without
    words are linked to equal texts only. Null keys never name a class unless all are null;
    repeated rows keep a row each; an empty table gives an empty result.
    """
    rows, full = grouped(df, key, text, threshold, width, recall, block, seed)
    return rows.join(full, "node").select(F.col("key").alias(key), F.col("rep").alias("text_class"), "class_id", "n_copies", "n_links")


def deduplicated(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    width: int = SHINGLE,
    recall: float = 0.999,
    block: int = 128,
    seed: int = 1,
) -> DataFrame:
    """One document of each group of near copies: the one with the least key, once. It is known by
    its key and text, so null keys and keys that several texts share lose no group and keep no copy."""
    name, node, kept = fresh(df, "_node"), fresh(df, "_kept_node"), fresh(df, "_kept")
    _, full = grouped(df, key, text, threshold, width, recall, block, seed)
    chosen = full.where("node = kept").select(F.col("node").alias(node), F.col("rep").alias(kept))
    marked = df.withColumn(name, F.md5(text_of(text)))
    same = (F.col(name) == F.col(node)) & F.col(key).eqNullSafe(F.col(kept))
    return marked.join(chosen, same, "left_semi").dropDuplicates([name]).drop(name)
