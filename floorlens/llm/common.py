"""Helpers shared by the text operators: stored tables, safe column names, word scans."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word once ASCII letters are lower-cased: all ASCII but digits and letters.
_SEPARATORS = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It comes from `spark.checkpoint.dir`. Only a local session, whose executors are the
    driver, gets a temporary folder when the setting is missing; a cluster is refused.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="floorlens-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: the lineage ends there, so a lost
    executor costs the readers' tasks only."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove a table that `stored` wrote, once nothing reads it any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def stored_bytes(df: DataFrame) -> int:
    """Size of a stored table's files, from Spark's own listing."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Files of a query's shuffles go when the query ends: what is read later is stored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_of(column: str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name close to `name` that `df` does not use (names compare without case)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = "_" + name
    return name


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of ASCII letters and digits or characters beyond ASCII, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SEPARATORS).split()


def word_places(text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words as `words_of` gives them, and where each starts and ends in code points."""
    raw = text.encode("utf-8", "surrogatepass")
    plain = raw.lower().translate(_SEPARATORS)
    inside = np.zeros(len(plain) + 2, np.int8)
    inside[1:-1] = np.frombuffer(plain, np.uint8) != 32
    steps = np.diff(inside)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    if len(raw) != len(text):
        before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
        starts, ends = before[starts], before[ends]
    return plain.split(), starts, ends


class WordHashes(dict):
    """64-bit hash of a word, remembered; forgotten in whole when it grows large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` words; one hash of the whole for a shorter, non-empty text."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        out = mix(out + hashes[i : n - width + 1 + i] + np.uint64(i + 1))
    return out


def batches(items: list, size: int) -> Iterator[list]:
    for i in range(0, len(items), size):
        yield items[i : i + size]
