"""Spelling variant grouping by blocked Gram matrices.

Words are runs of letters; two are near if one inserted, deleted or replaced letter makes
them equal. Near words have letter counts at a squared distance of 1 (lengths differ by
one) or 2 (equal lengths). So words are dealt into blocks of equal length and equal counts
of six letter classes; only blocks whose class counts allow such a distance meet, a block
with those of its own length and of the next. For two blocks the matrix product of their
letter counts gives all squared distances, |a|^2 + |b|^2 - 2ab; pairs of at most two are
verified letter by letter. A block holds a bounded number of words and letters: a large
class is dealt into several, and each pair of blocks is a row that any task can take.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.llm.common import stored

#: Runs of letters in Latin-1 once ASCII letters are lower-cased.
_RUN = re.compile(rb"[a-z\xc0-\xff]+")
_SLICE = 1 << 20
_HELD = 150_000
#: Letter classes by which words are dealt into blocks.
CLASSES = 6
BLOCK_WORDS = 1024
BLOCK_LETTERS = 1 << 16
#: Column of each letter: a to z, then the upper quarter of Latin-1.
LETTERS = 26 + 64
_LETTER = np.zeros(256, np.int64)
_LETTER[97:123] = np.arange(26)
_LETTER[192:] = np.arange(26, LETTERS)
_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])
_DEALT = pa.schema([("word", pa.string()), ("block", pa.string())])


def runs_of(text: str) -> Iterator[Counter]:
    """Counts of the lower-cased runs, slice by slice; no run is cut.

    A character beyond Latin-1 becomes a question mark and so ends a run, as it should.
    """
    data = text.encode("latin-1", "replace").lower()
    start = 0
    while start < len(data):
        end = start + _SLICE
        if end < len(data):  # on to the end of the run
            end = _RUN.match(data, end).end() if _RUN.match(data, end) else end
        yield Counter(_RUN.findall(data[start:end]))
        start = end


def cut_run(run: bytes, seed: int, one_in: int) -> bytes:
    """The run, less one letter if its hash divides: `seed` is the crc32 of all before the run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = 5, least_count: int = 3, one_in: int = 97) -> DataFrame:
    """Rows (word, n): runs with damaged occurrences, of enough letters and occurrences.

    Counts are summed in each task before they are shuffled, so a word that fills a third of
    the table costs a row a task. A null key is the empty string, a null or empty text has
    no runs, repeated rows count again, other columns are left out, an empty table gives none.
    """

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.record_batch({"word": [w.decode("latin-1") for w in held], "n": list(held.values())}, _COUNTED)
            held.clear()
            return batch

        for frame in frames:
            for name, value in zip(frame["name"], frame["value"], strict=True):
                seed = zlib.crc32(f"{name.as_py()}:".encode())
                for runs in runs_of(value.as_py()):
                    for run, n in runs.items():
                        if len(run) >= least_letters:
                            word = cut_run(run, seed, one_in)
                            if len(word) >= least_letters:
                                held[word] = held.get(word, 0) + n
                    if len(held) > _HELD:
                        yield out()
        yield out()

    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"), F.col(text).cast("string").alias("value"))
    counted = rows.where(F.length("value") >= least_letters).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def class_counts(word: str) -> list[int]:
    out = [0] * CLASSES
    for letter in word:
        out[ord(letter) % CLASSES] += 1
    return out


def partners(counts: list[int]) -> list[str]:
    """Blocks that a block meets: itself, those where a letter changed to one of a later class
    (the other way round, that block meets this one), and those with a letter more."""
    out = [counts]
    for a in range(CLASSES):
        more = counts.copy()
        more[a] += 1
        out.append(more)
        for b in range(a):
            if more[b]:
                out.append([x - (i == b) for i, x in enumerate(more)])
    return [",".join(map(str, x)) for x in out]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes and letter counts of words of one length."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    cells = _LETTER[codes] + (np.arange(len(words)) * LETTERS)[:, None]
    counts = np.bincount(cells.ravel(), minlength=len(words) * LETTERS).reshape(-1, LETTERS)
    # products of counts stay exact below 2^24 in single precision
    return codes, counts.astype(np.float32 if codes.shape[1] < 2000 else np.float64)


def near_in_blocks(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs of two blocks; each pair once if both are the `same` block.

    The words of `right` are as long as those of `left`, or one letter longer.
    """
    a, x = _letters(left)
    b, y = (a, x) if same else _letters(right)
    longer = b.shape[1] - a.shape[1]
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(distance <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    keep = []
    step = max(1, (1 << 22) // b.shape[1])
    for at in range(0, len(i), step):
        p, q = a[i[at : at + step]], b[j[at : at + step]]
        if not longer:
            keep.append((p != q).sum(1) == 1)
        else:  # what agrees from the start and what agrees from the end cover the shorter word
            head = np.cumprod(p == q[:, :-1], 1, dtype=np.uint8).sum(1, dtype=np.int64)
            tail = np.cumprod((p == q[:, 1:])[:, ::-1], 1, dtype=np.uint8).sum(1, dtype=np.int64)
            keep.append(head + tail >= a.shape[1])
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[keep], j[keep]


def near_pairs(words: DataFrame, word: str = "word") -> DataFrame:
    """Rows (word, near): pairs of words one edit apart, each pair once. Words are distinct
    and of letters in Latin-1; nulls and empty words have no partners.

    A word has at most some hundred times its length near words, so the pairs grow with the
    words; the blocks that are compared are arrays of at most about `BLOCK_WORDS` words.
    """

    def dealt(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            names = frame["word"].to_pylist()
            yield pa.record_batch({"word": names, "block": [",".join(map(str, class_counts(w))) for w in names]}, _DEALT)

    named = words.select(F.col(word).cast("string").alias("word")).where(F.length("word") > 0)
    blocks = named.mapInArrow(dealt, "word string, block string")
    sizes = blocks.groupBy("block").agg(F.count("*").alias("words"), F.sum(F.length("word")).alias("letters"))
    parts = F.ceil(F.greatest(F.col("words") / BLOCK_WORDS, F.col("letters") / BLOCK_LETTERS)).cast("long")
    sizes = sizes.select(F.col("block").alias("of"), parts.alias("parts"))
    blocks = blocks.join(sizes, F.col("block") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")))
    blocks = stored(blocks.groupBy("block", "part").agg(F.collect_list("word").alias("words")), "spelling_blocks")

    meets = F.udf(lambda block: partners([int(x) for x in block.split(",")]), "array<string>")

    # comparing is all work and few bytes: keep the session's number of tasks
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = blocks.select(F.col("block").alias("a"), F.col("part").alias("i"), F.col("words").alias("left"), F.explode(meets("block")).alias("meets"))
    right = blocks.select(F.col("block").alias("b"), F.col("part").alias("j"), F.col("words").alias("right"))
    met = left.join(right, F.col("meets") == F.col("b")).where((F.col("a") != F.col("b")) | (F.col("i") <= F.col("j")))
    met = met.select("left", "right", ((F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))).alias("same")).repartition(tasks)

    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for k in range(frame.num_rows):
                x, y = (frame[side][k].as_py() for side in ("left", "right"))
                i, j = near_in_blocks(x, y, frame["same"][k].as_py())
                if len(i):
                    yield pa.record_batch({"word": [x[k] for k in i], "near": [y[k] for k in j]})

    return met.mapInArrow(compare, "word string, near string")


def variants(words: DataFrame, least_ratio: int = 2) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for words (word, n).

    `form` is the near word of largest n (ties: least in code-point order) if its n is at
    least `least_ratio` times the word's, else null; `root` follows forms to the last. n at
    least doubles at each step, so a chain has at most log2(largest n) steps and its end is
    found by that many halvings, each a join of (word, root) with itself.
    """
    words = stored(words.select("word", "n"), "spelling_words")
    pairs = stored(near_pairs(words), "spelling_pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    counts = words.withColumnsRenamed({"word": "w", "n": "m"})
    met = both.join(counts, F.col("near") == F.col("w"))
    best = met.groupBy(F.col("word").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("minus"), F.col("near"))).alias("best")
    )
    strong = -F.col("best.minus") >= least_ratio * F.col("n")
    out = words.join(best, F.col("word") == F.col("of"), "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.minus")).alias("form_n"),
    )
    out = stored(out, "spelling_forms")
    largest = out.agg(F.max("n")).first()[0]
    steps = max(1, math.ceil(math.log(max(2, largest or 2), least_ratio)))
    roots = out.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        ahead = roots.select(F.col("word").alias("w"), F.col("root").alias("next"))
        roots = roots.join(ahead, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root"))
        roots = stored(roots, "spelling_roots")
    roots = roots.withColumnRenamed("word", "w")
    return out.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
