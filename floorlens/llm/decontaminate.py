"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is a set of windows: its runs of `window` words, or the whole item if
it is shorter. A window is a set of shingles of `width` words, ordered by how rare they are
in the documents. As a window counts only if it is contained whole, one necessary prefix
token is enough: its rarest shingle. Documents are joined with windows on that token; a
position gives the window's place, which must lie inside the passage (length and positional
bounds), and the words there must equal the window's words.

Documents are scanned once. A bit map of fixed size holds the benchmark's shingles, so what
is sent to the tasks does not grow with the benchmark; each document gives up only its
passages (maximal runs of words covered by shingles in the map), with their words. Rarity,
join and check then work on these passages, which are stored in the shared folder. A shingle
of a passage goes into the join with the few words that a window around it can reach, never
with its passage, so a copied passage of n words costs n rows of bounded width.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floorlens.llm.common import WordHashes, mix, shingle_hashes, stored, text_of, words_of

_MAP_BITS = 1 << 24
_ROWS = 8192  # shingles of a long passage sent at a time
_BIT = np.array([1, 2, 4, 8, 16, 32, 64, 128], np.uint8)


def _slots(hashes: np.ndarray, width: int) -> np.ndarray:
    """Bit of each shingle; shingles of other widths have other bits."""
    return mix(hashes + np.uint64(width)) & np.uint64(_MAP_BITS - 1)


def item_windows(benchmark: DataFrame, item: str, text: str, window: int, width: int) -> DataFrame:
    """Rows (item, words, shingles): the distinct windows of each item and the hashes of their
    shingles, as longs, in order. Items without words have none."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            rows = []
            for name, value in zip(frame["item"], frame["text"], strict=True):
                words = words_of(value)
                if not words:
                    continue
                size = min(window, len(words))
                shingles = shingle_hashes(hashes.of(words), width).view(np.int64)
                per = size - min(width, size) + 1
                for i in {tuple(words[i : i + size]): i for i in range(len(words) - size + 1)}.values():
                    rows.append((name, [w.decode("utf-8", "replace") for w in words[i : i + size]], shingles[i : i + per].tolist()))
            yield pd.DataFrame(rows, columns=["item", "words", "shingles"])

    items = benchmark.select(F.col(item).cast("string").alias("item"), text_of(text).alias("text"))
    return items.mapInPandas(cut, "item string, words array<string>, shingles array<bigint>")


def shingle_map(windows: DataFrame, width: int) -> dict[int, bytes]:
    """A bit map of fixed size for each shingle width in use (items shorter than `width` words
    are one shingle): partial maps are made in the tasks and joined."""

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots: dict[int, list[np.ndarray]] = {}
        for frame in frames:
            for words, shingles in zip(frame["words"], frame["shingles"], strict=True):
                size = min(width, len(words))
                slots.setdefault(size, []).append(_slots(np.asarray(shingles, np.int64).view(np.uint64), size))
        for size, parts in slots.items():
            yield pd.DataFrame({"size": size, "slot": np.unique(np.concatenate(parts)).astype(np.int64)})

    maps: dict[int, np.ndarray] = {}
    filled = windows.select("words", "shingles").mapInPandas(fill, "size int, slot long").distinct()
    for row in filled.toLocalIterator():  # at most as many rows as bits
        bits = maps.setdefault(row["size"], np.zeros(_MAP_BITS // 8, np.uint8))
        bits[row["slot"] >> 3] |= _BIT[row["slot"] & 7]
    return {size: bits.tobytes() for size, bits in maps.items()}


def longest_word(windows: DataFrame) -> int:
    """Bytes of the benchmark's longest word (0 if it has none): longer words match nothing."""
    longest = F.array_max(F.transform("words", F.octet_length))
    return windows.agg(F.max(longest)).first()[0] or 0


def short_runs(words: list[bytes], longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """(place, words) of the runs of `words` between those of more than `longest` bytes."""
    cuts = [i for i, word in enumerate(words) if len(word) > longest]
    for start, end in zip([0, *(i + 1 for i in cuts)], [*cuts, len(words)], strict=True):
        if start < end:
            yield start, words[start:end]


def passages(df: DataFrame, key: str, text: str, maps, width: int, longest: int) -> DataFrame:
    """Rows (key, n_words, runs): each document's runs of words that shingles in the map cover,
    as structs (start, words). Words of more than `longest` bytes are in no run."""

    def scan(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        bits = {size: np.frombuffer(raw, np.uint8) for size, raw in maps.value.items()}
        for texts in frames:
            counts, runs = [], []
            for value in texts:
                words = words_of(value)
                counts.append(len(words))
                found = []
                if words and bits:
                    own = hashes.of(words)
                    edge = np.zeros(len(words) + 1, np.int32)
                    for size, table in bits.items():
                        if size > len(words):
                            continue
                        slots = _slots(shingle_hashes(own, size), size)
                        starts = np.flatnonzero(table[slots >> np.uint64(3)] & _BIT[slots & np.uint64(7)])
                        np.add.at(edge, starts, 1)
                        np.add.at(edge, starts + size, -1)
                    inside = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
                    turns = np.flatnonzero(inside[1:] != inside[:-1])
                    for start, end in turns.reshape(-1, 2).tolist():
                        for skip, run in short_runs(words[start:end], longest):
                            found.append({"start": start + skip, "words": [w.decode("utf-8", "replace") for w in run]})
                runs.append(found)
            yield pd.DataFrame({"n_words": counts, "runs": runs})

    kind = "n_words long, runs array<struct<start: int, words: array<string>>>"
    found = F.pandas_udf(scan, kind)(text_of(text))
    return df.select(F.col(key).alias("key"), found.alias("f")).select("key", "f.*")


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    width: int = 5,
) -> DataFrame:
    """One row for each row of `docs`: key, n_words, n_hit, items (sorted array), contaminated,
    hits (array of structs start, end: the covered words).

    Null or empty texts have no words and no hits; items without words never occur; null
    keys and repeated rows keep a row each, with its own hits. An empty `docs` gives an empty
    result, an empty `benchmark` no hits. Other columns are left out.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, item, item_text, window, width), "windows")
    maps = spark.sparkContext.broadcast(shingle_map(windows, width))  # 2 MB a width
    found = passages(docs, key, text, maps, width, longest_word(windows))
    found = found.withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "passages")
    runs = found.select("row", F.explode("runs").alias("run")).select("row", "run.start", "run.words")
    # shingles of the passages, at each width in use, with their place
    sizes = sorted(maps.value) or [width]
    tokens = shingles_of(runs, sizes, width, window)
    # rarity over all documents, and the necessary prefix token of each window
    rarity = shingles_of(runs, sizes, width, None).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    numbered = windows.select("item", "words", "shingles").withColumn("window", F.xxhash64(F.concat_ws(" ", "words")))
    exploded = numbered.select("item", "words", F.posexplode("shingles").alias("at", "shingle"), F.size("words").alias("size"))
    ranked = exploded.join(rarity, "shingle").groupBy("item", "words", "size").agg(
        F.min(F.struct("n", "shingle", "at")).alias("rarest"), F.count(F.lit(1)).alias("present")
    )
    per = F.col("size") - F.least(F.col("size"), F.lit(width)) + 1
    prefix = ranked.where(F.col("present") == per).select(
        "item", F.col("words").alias("needed"), "size", F.col("rarest.shingle").alias("shingle"), F.col("rarest.at").alias("at")
    )
    joined = tokens.join(prefix, "shingle").withColumns(
        {"from": F.col("place") - F.col("at"), "near": F.split("around", " ")}
    )
    begin = F.col("from") - F.col("first")
    bounded = joined.where((begin >= 0) & (begin + F.col("size") <= F.size("near")))
    exact = bounded.where(F.slice("near", begin + 1, F.col("size")) == F.col("needed"))
    spans = exact.select("row", "item", "from", (F.col("from") + F.col("size")).alias("to"))
    # covered words: each window adds what no earlier one in the document covers
    order = Window.partitionBy("row").orderBy("from", "to")
    covered = F.coalesce(F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cover = (
        spans.groupBy("row", "from").agg(F.max("to").alias("to"))
        .withColumn("new", F.greatest(F.col("from"), covered))
        .where("to > new")
        .groupBy("row")
        .agg(F.sum(F.col("to") - F.col("new")).alias("n_hit"), F.sort_array(F.collect_list(F.struct(F.col("new").alias("start"), F.col("to").alias("end")))).alias("hits"))
    )
    items = spans.select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    hit = cover.join(items, "row")
    return found.select("row", F.col("key").alias(key), "n_words").join(hit, "row", "left").select(
        key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.coalesce("hits", F.array().cast("array<struct<start:int,end:int>>")).alias("hits"),
    )


def shingles_of(runs: DataFrame, sizes: list[int], width: int, window: int | None) -> DataFrame:
    """Rows (shingle, row, place, first, around) for each shingle of each passage: its place in the
    text, and the words (joined by spaces) that a window holding it can reach in the passage, from
    word `first` on. Without a `window`, rows (shingle) only. Some thousand rows leave at a time."""
    before = max(window - width, 0) if window else 0

    def pieces(frame: pd.DataFrame, hashes: WordHashes) -> Iterator[tuple[np.ndarray, ...]]:
        for row, start, listed in zip(frame["row"], frame["start"], frame["words"], strict=True):
            words = list(listed)
            own = hashes.of([w.encode("utf-8", "surrogatepass") for w in words])
            for size in sizes:
                if size > len(words):
                    continue
                shingles = shingle_hashes(own, size).view(np.int64)
                if window is None:
                    yield (shingles,)
                    continue
                for part in range(0, len(shingles), _ROWS):
                    at = np.arange(part, min(part + _ROWS, len(shingles)))
                    first = np.maximum(at - before, 0)
                    around = [" ".join(words[i:j]) for i, j in zip(first.tolist(), (at + window).tolist(), strict=True)]
                    yield shingles[at], np.full(len(at), row), start + at, start + first, np.array(around, object)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            held, rows = [], 0
            for piece in pieces(frame, hashes):
                held.append(piece)
                rows += len(piece[0])
                if rows >= _ROWS:
                    yield joined(held)
                    held, rows = [], 0
            if held:
                yield joined(held)

    def joined(held: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        names = ("shingle", "row", "place", "first", "around")
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, zip(*held, strict=True), strict=False)})

    kind = "shingle long" if window is None else "shingle long, row long, place long, first long, around string"
    return runs.mapInPandas(cut, kind)


def decontamination_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    return found.select(
        F.col(key).alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )
