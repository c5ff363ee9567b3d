"""Two-pass external shuffle into shards of equal row counts, in DataFrame functions only.

Pass one scatters: every record gets a seeded hash and is written with it to the shared
folder. Pass two deals the stored records by that hash into buckets that fit in a task's
memory, puts each bucket in a Fisher-Yates order (`shuffle` of an array, with a seed) and
numbers it from the bucket's offset. The number modulo the shard count is the shard, the
quotient the slot, so shards differ by one row at most and slots have no gaps.

The hash covers a row's running number besides its key, so no hot key, text or repeated row
can fill a bucket. It is stored before it is used: both the counts and the records see the
same hash, and as a bucket is sorted by it before the shuffle, a lost task comes back with
the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floorlens.llm.common import fresh, stored, text_of


def record_size(text: str) -> Column:
    """UTF-8 bytes of the text plus one for its end; a null text has none of its own."""
    return (F.octet_length(text_of(text)) + F.lit(1)).cast("long")


def bucket_count(total_bytes: int, partitions: int, bucket_bytes: int) -> int:
    """Buckets of about `bucket_bytes` at most, and a few for each shuffle partition."""
    return max(4 * partitions, -(-total_bytes // bucket_bytes))


def shuffled_shards(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = 16,
    seed: int = 20,
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """All columns of `df` plus `shard` (int), `slot` (long) and `bucket` (long).

    Columns of these names in `df` give way to the new ones. Null keys and texts, ties and
    repeated rows are rows like any other, each with a slot of its own; an empty table gives
    an empty result. A single text larger than `bucket_bytes` makes one larger bucket.
    """
    df = df.drop("shard", "slot", "bucket")
    spark = df.sparkSession
    mark, size, record, at, place = (fresh(df, x) for x in ("_mark", "_size", "_record", "_at", "_place"))
    # pass one
    number = F.monotonically_increasing_id()
    scattered = stored(
        df.withColumns({mark: F.xxhash64(F.lit(seed), F.col(key).cast("string"), number), size: record_size(text)}),
        "scatter",
    )
    total = scattered.agg(F.sum(size)).first()[0] or 0
    n = bucket_count(total, int(spark.conf.get("spark.sql.shuffle.partitions")), bucket_bytes)
    scattered = scattered.withColumn("bucket", F.pmod(mark, F.lit(n)))
    # offsets: running totals within runs of 1,024 buckets, and of the runs
    runs = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    runs = runs.withColumn("_run", F.floor(F.col("bucket") / 1024))
    before = Window.unboundedPreceding, -1
    heads = runs.groupBy("_run").agg(F.sum("_n").alias("_rows"))
    head = F.coalesce(F.sum("_rows").over(Window.orderBy("_run").rowsBetween(*before)), F.lit(0))
    inside = F.sum("_n").over(Window.partitionBy("_run").orderBy("bucket").rowsBetween(*before))
    offsets = runs.join(heads.select("_run", head.alias("_head")), "_run").select(
        "bucket", (F.col("_head") + F.coalesce(inside, F.lit(0))).alias(at)
    )
    # pass two
    kept = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = scattered.select("bucket", F.struct(F.col(mark).alias("mark"), kept).alias(record))
    by_mark = F.array_sort(
        F.collect_list(record),
        lambda a, b: F.when(a["mark"] < b["mark"], -1).when(a["mark"] > b["mark"], 1).otherwise(0),
    )
    dealt = rows.groupBy("bucket").agg(F.shuffle(by_mark, seed).alias(record))
    numbered = dealt.join(offsets, "bucket").select("bucket", at, F.posexplode(record).alias(place, record))
    number = F.col(at) + F.col(place)
    return numbered.select(
        f"{record}.row.*",
        F.pmod(number, F.lit(shards)).cast("int").alias("shard"),
        F.floor(number / shards).cast("long").alias("slot"),
        "bucket",
    )


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write the shards as folders `shard=k`, each file in slot order within its task."""
    out = shuffled_shards(df, **options)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digest(sharded: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes, checksums and places of the sharded rows."""
    return sharded.select(
        F.col(key).alias("doc_id"),
        record_size(text).alias("size"),
        F.crc32(text_of(text)).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "bucket",
    )
