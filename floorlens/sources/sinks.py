"""Partitioned Parquet tables: replace, upsert, insert, delete, export.

Tables are partitioned by the columns a slice is addressed with, so replacing
or deleting a slice touches only its folders.  Writes use dynamic partition
overwrite: Spark stages the new files and moves them in when all tasks are
done, so lost executors and retried tasks do not leave half-written slices.
A driver lost while the folders are exchanged can leave some of them without
their old rows; merges keep a copy beside the table until then (`recover`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import dedupe_collapse, duplicate_report
from . import schemas
from .clean import require_valid


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"{path} could not be deleted")


def partition_folder(spark: SparkSession, path: str, by: list[str], row) -> str:
    """The folder of a partition, with the names that Spark gives it."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = [utils.getPartitionPathString(c, None if row[c] is None else str(row[c])) for c in by]
    return "/".join([path, *parts])


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces exactly the partitions that occur in df.

    Rows are gathered per partition first so that each folder gets few files;
    the rebalance hint lets AQE split a partition that is too large for one task.
    """
    df = df.hint("rebalance", *[F.col(c) for c in by])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _merged_folder(path: str) -> str:
    return f"{path.rstrip('/')}__merged"


def commit_merged(df: DataFrame, path: str, by: list[str]) -> None:
    """`overwrite_partitions` for rows that were read from the table itself.

    The whole new content of the partitions is written beside the table first. If the
    driver is lost while partitions are exchanged, `recover` finishes from that copy, so
    rows that were stored before the batch are not lost with their old folders. The copy has no
    folders: it is read whole, and every task would put a small file into each of them.
    """
    copy = f"{_merged_folder(path)}/{uuid.uuid4().hex}"
    df.write.parquet(copy)
    overwrite_partitions(df.sparkSession.read.schema(df.schema).parquet(copy), path, by)
    _drop(df.sparkSession, copy)


def recover(spark: SparkSession, path: str, by: list[str], schema: T.StructType) -> int:
    """Finishes the exchange that a lost driver left open; returns how many were open.

    A complete copy is written again, an incomplete one is dropped: its table was not
    touched yet. A table has one writer at a time, so at most one copy is complete.
    """
    fs, folder = _fs(spark, _merged_folder(path))
    if not fs.exists(folder):
        return 0
    done = 0
    for status in fs.listStatus(folder):
        copy = status.getPath().toString()
        if exists(spark, f"{copy}/_SUCCESS"):
            overwrite_partitions(spark.read.schema(schema).parquet(copy), path, by)
            done += 1
        _drop(spark, copy)
    return done


def replace_slice(
    df: DataFrame, path: str, by: tuple[str, ...] = ("date", "hole"), slices: tuple[str, ...] = ("date", "hole")
) -> None:
    """Replaces each (date, venue) of the batch; other venues of the day stay.

    Where a partition holds many slices, `df` must not read the table.
    """
    if set(slices) <= set(by):
        return overwrite_partitions(df, path, list(by))
    replace_rows(df.sparkSession, df, path, list(slices), list(by), df.schema, null_slices=True)


def replace_day(
    spark: SparkSession, df: DataFrame, path: str, by: tuple[str, ...] = ("date", "hole"), schema: T.StructType = schemas.RAW
) -> None:
    """Replaces whole days: venues missing from the batch are dropped.

    In a table by day a day's folder is replaced with all its venues. Rows without a venue count
    for the days that are replaced, but are not stored in either kind of table.
    """
    if list(by) == ["date"]:
        named = df.where(F.col("hole").isNotNull())
        overwrite_partitions(named, path, ["date"])
        days = df.where(F.col("date").isNotNull()).select("date").distinct()
        _drop_partitions(spark, path, days.join(named.select("date").distinct(), "date", "left_anti"), ["date"])
        return
    dates = [r[0] for r in df.select("date").distinct().collect()]  # one value per day of the batch
    overwrite_partitions(df, path, list(by))
    kept = df.select(*by).distinct()
    old = spark.read.schema(schema).parquet(path).where(F.col("date").isin(dates)).select(*by).distinct()
    _drop_partitions(spark, path, old.join(kept, list(by), "left_anti"), list(by))


def _drop_partitions(spark: SparkSession, path: str, keys: DataFrame, by: list[str]) -> int:
    """Deletes folders.  The key list is as long as the number of folders, like Spark's own file index."""
    rows = keys.collect()
    for r in rows:
        _drop(spark, partition_folder(spark, path, by, r))
    return len(rows)


def write_shards(spark: SparkSession, df: DataFrame, root: str) -> None:
    """Writes rows as folders `data_YYYYMMDD` by their date; a day that is there already is replaced.

    All days are written in one job beside the folders and then put in place one by one.
    """
    staging = f"{root.rstrip('/')}__staging/{uuid.uuid4().hex}"
    named = df.where(F.col("date").isNotNull()).withColumn("__shard", F.date_format("date", "yyyyMMdd"))
    named.drop("date").hint("rebalance", "__shard").write.partitionBy("__shard").parquet(staging)
    fs, folder = _fs(spark, staging)
    fs.mkdirs(_fs(spark, root)[1])
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("__shard="):
            to = f"{root.rstrip('/')}/data_{name[-8:]}"
            _drop(spark, to)
            if not fs.rename(status.getPath(), _fs(spark, to)[1]):
                raise OSError(f"{to} could not be put in place")
    _drop(spark, staging)


def delete_slice(
    spark: SparkSession,
    path: str,
    date_from: dt.date,
    date_to: dt.date,
    hole: str | None = None,
    date: str = "date",
    by: tuple[str, ...] = ("date", "hole"),
    schema: T.StructType = schemas.RAW,
) -> int:
    """Deletes a date range, optionally of one venue; returns the number of rows.

    Whole partitions are dropped as folders.  When the venue is not a partition
    column the days that hold it are rewritten without it, as a merge.
    """
    rows = spark.read.schema(schema).parquet(path)
    rows = rows.where(F.col(date).between(F.lit(date_from), F.lit(date_to)))
    hit = rows if hole is None else rows.where(F.col("hole") == hole)
    counts = hit.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    if hole is None or "hole" in by:
        doomed = counts.collect()
        for r in doomed:
            _drop(spark, partition_folder(spark, path, list(by), r))
        return sum(r["n"] for r in doomed)
    recover(spark, path, list(by), schema)
    touched = spark.createDataFrame(counts.collect(), counts.schema)  # a row for each folder that holds the venue
    doomed = F.col(date).between(F.lit(date_from), F.lit(date_to)) & F.col("hole").eqNullSafe(hole)
    rest = touched_partitions(spark, touched, path, list(by), schema).where(~F.coalesce(doomed, F.lit(False)))
    gone = touched.join(rest.select(*by).distinct(), list(by), "left_anti").collect()
    commit_merged(rest, path, list(by))
    for r in gone:
        _drop(spark, partition_folder(spark, path, list(by), r))
    return touched.agg(F.sum("n")).first()[0] or 0


@dataclass(frozen=True)
class UpsertResult:
    inserted: int
    updated: int


def merged(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows, and the target rows whose key the source lacks."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source, allowMissingColumns=True)


def absent(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks."""
    return source.join(target.select(*keys), keys, "left_anti")


def touched_partitions(spark: SparkSession, batch: DataFrame, path: str, by: list[str], schema: T.StructType) -> DataFrame:
    """The table's rows in the partitions of the batch, read with a literal partition filter.

    The batch's partition keys are collected: as many as the folders it will write.
    """
    keys = batch.select(*by).distinct().collect()
    rows = spark.read.schema(schema).parquet(path)
    if not keys:
        return rows.where("false")
    for c in by:
        values = {k[c] for k in keys}
        given = F.col(c).isin([v for v in values if v is not None])
        rows = rows.where(given | F.col(c).isNull() if None in values else given)
    return rows


def upsert(
    spark: SparkSession, source: DataFrame, path: str, keys: list[str], by: list[str], schema: T.StructType
) -> UpsertResult:
    """Update-or-insert by key.  Rows of the target that the source lacks stay.

    The source is written once to a staging folder beside the table; counting,
    finding the touched partitions and merging all read that copy, so the source
    is computed once and the merge can be repeated if it fails.
    """
    staging = f"{path.rstrip('/')}__staging/{uuid.uuid4().hex}"
    source.select(*[f.name for f in schema.fields]).write.parquet(staging)
    new = spark.read.schema(schema).parquet(staging)
    total = new.count()
    updated = 0
    recover(spark, path, by, schema)
    if exists(spark, path):
        old = touched_partitions(spark, new, path, by, schema)
        updated = old.join(new.select(*keys), keys, "left_semi").count()
        commit_merged(merged(old, new, keys), path, by)
    else:
        overwrite_partitions(new, path, by)
    _drop(spark, staging)
    return UpsertResult(total - updated, updated)


def rewrite_deduped(
    spark: SparkSession,
    path: str,
    date_from: dt.date,
    date_to: dt.date,
    key: str = "id",
    ts: str = "timestamp",
    ties: tuple[str, ...] = (),
    by: tuple[str, ...] = ("date", "hole"),
    schema: T.StructType = schemas.RAW,
) -> DataFrame:
    """Rewrites the days of a range with one row per id, in one job for the whole range.

    Only partitions that hold copies are rewritten, which may hold many slices each. Returns rows, distinct ids and copies
    of each slice as they were before.
    """
    recover(spark, path, list(by), schema)
    rows = spark.read.schema(schema).parquet(path).where(F.col("date").between(F.lit(date_from), F.lit(date_to)))
    slices = ["date", "hole"]
    report = duplicate_report(rows, slices, key).where("has_duplicates").collect()  # one row a slice with copies
    before = spark.createDataFrame(report, "date date, hole string, total long, unique_count long, duplicate_count long, has_duplicates boolean")
    if report:
        touched, held = touched_partitions(spark, before, path, list(by), schema), before.select(*slices)
        once = dedupe_collapse(touched.join(held, slices, "left_semi"), key, ts, list(ties))
        if not set(slices) <= set(by):  # other slices of the same partitions stay as they are
            once = once.unionByName(touched.join(held, slices, "left_anti"))
        commit_merged(once, path, list(by))
    return before


def replace_rows(
    spark: SparkSession, df: DataFrame, path: str, slices: list[str], by: list[str], schema: T.StructType, null_slices: bool = False
) -> None:
    """Replaces the slices of the batch in a table whose partitions hold many slices each, such as days in
    folders of a year: only partitions of the batch are read and written again. `df` must not read the table.
    With `null_slices` rows without a venue or day are a slice too, as a folder of them would be."""
    rows = df.select(*[f.name for f in schema.fields])
    recover(spark, path, by, schema)
    if not exists(spark, path):
        return overwrite_partitions(rows, path, by)
    old = touched_partitions(spark, rows, path, by, schema)
    new = rows.select(*slices).distinct()
    if null_slices:
        new = new.withColumnsRenamed({c: f"__{c}" for c in slices})
        kept = old.join(new, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in slices], "left_anti")
    else:
        kept = absent(old, new, slices)
    commit_merged(kept.unionByName(rows), path, by)


#: Folders of a key index: a batch opens those of its own keys only.
KEY_BUCKETS = 64


def _index_folder(path: str) -> str:
    return f"{path.rstrip('/')}__keys"


def _bucketed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int").alias("bucket"))


def build_key_index(spark: SparkSession, path: str, keys: list[str], schema: T.StructType) -> None:
    """Writes the stored keys beside the table, in folders by their hash; reads the key columns only."""
    stored = spark.read.schema(schema).parquet(path).select(*keys).distinct()
    _bucketed(stored, keys).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(_index_folder(path))


def _indexed_keys(spark: SparkSession, rows: DataFrame, path: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """Stored keys in the index folders that the keys of `rows` belong to."""
    kinds = T.StructType([*(schema[k] for k in keys), T.StructField("bucket", T.IntegerType())])
    buckets = [r[0] for r in _bucketed(rows, keys).select("bucket").distinct().collect()]  # at most KEY_BUCKETS
    return spark.read.schema(kinds).parquet(_index_folder(path)).where(F.col("bucket").isin(buckets)).drop("bucket")


def insert_ignore(
    spark: SparkSession, source: DataFrame, path: str, keys: list[str], by: list[str], schema: T.StructType
) -> None:
    """Adds the rows whose key is new; existing rows win, wherever they lie. The source has unique keys.

    If the partition columns are part of the key, an equal key can only lie in the batch's own
    partitions, and these are read. Otherwise stored keys are looked up in an index beside the
    table. It is open while a batch is added: an index that is missing, or was left open by a lost
    driver, is built again from the table's key columns.
    """
    recover(spark, path, by, schema)
    rows = source.select(*[f.name for f in schema.fields])
    if set(by) <= set(keys):
        if exists(spark, path):
            rows = absent(rows, touched_partitions(spark, rows, path, by, schema), keys)
        rows.hint("rebalance", *[F.col(c) for c in by]).write.mode("append").partitionBy(*by).parquet(path)
        return
    index = _index_folder(path)
    if not exists(spark, path):
        overwrite_partitions(rows, path, by)
        return build_key_index(spark, path, keys, schema)
    if not exists(spark, f"{index}/_SUCCESS"):
        build_key_index(spark, path, keys, schema)
    staging = f"{path.rstrip('/')}__staging/{uuid.uuid4().hex}"
    absent(rows, _indexed_keys(spark, rows, path, keys, schema), keys).write.parquet(staging)
    new = spark.read.schema(schema).parquet(staging)
    _drop(spark, f"{index}/_SUCCESS")  # open: from here on the table may be ahead of the index
    new.hint("rebalance", *[F.col(c) for c in by]).write.mode("append").partitionBy(*by).parquet(path)
    _bucketed(new, keys).hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(index)  # closes it
    _drop(spark, staging)


def sync_dimension(df: DataFrame, path: str) -> None:
    """Truncate and load; an empty input empties the table."""
    df.write.mode("overwrite").parquet(path)


def sync_range(
    spark: SparkSession, source: DataFrame, path: str, date_from: dt.date, date_to: dt.date
) -> DataFrame:
    """Copies a date range in one job; returns rows per (date, venue)."""
    rows = source.where(F.col("date").between(F.lit(date_from), F.lit(date_to)))
    replace_slice(rows, path)
    back = spark.read.schema(schemas.RAW).parquet(path)
    back = back.where(F.col("date").between(F.lit(date_from), F.lit(date_to)))
    return back.groupBy("date", "hole").agg(F.count(F.lit(1)).alias("n"))


def export_csv(df: DataFrame, path: str) -> None:
    """Quoted CSV with a header; an empty or invalid batch is refused."""
    require_valid(df).write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def write_layouts(layouts: DataFrame, path: str) -> None:
    """Layout documents under venue and floor folders."""
    layouts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "hole_slug", "floor_slug"
    ).json(path)


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: list[str], seq: str = "seq", nulls: str = "set_null"
) -> DataFrame:
    """Target after a change set of rows (op, keys, values, seq), as if applied one by one.

    op is add, update or delete.  An add makes the row if it is absent and otherwise
    changes it; an update of an absent row does nothing; a delete takes the row with
    all its values.  A change sets the columns it has a value for, and to NULL those
    that its optional array column `nulls` names.  Keys compare NULL-safe.

    Whether a row exists is decided by its last add or delete; its values come from the
    changes after the last delete that found the row there.
    """
    cols = [c for c in target.columns if c not in keys]
    given = [c for c in cols if c in changes.columns]
    key = Window.partitionBy(*keys)
    so_far = key.orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    decides = F.when(F.col("op") != "update", F.col("op"))
    marked = changes.withColumns(
        {
            "__state": F.last(decides, ignorenulls=True).over(so_far),
            "__deleted": F.max(F.when(F.col("op") == "delete", F.col(seq))).over(key),
        }
    )
    live = (F.col("op") != "delete") & (F.col("__deleted").isNull() | (F.col(seq) > F.col("__deleted")))
    sure = live & (F.col("__state") == "add")  # without an add or delete before it, the target decides
    maybe = live & (F.coalesce("__state", F.lit("add")) == "add")
    aggs = [F.max_by(decides, F.when(decides.isNotNull(), F.col(seq))).alias("__op"), F.max("__deleted").alias("__deleted")]
    for c in given:
        sets = F.col(c).isNotNull()
        if nulls in changes.columns:
            sets = sets | F.coalesce(F.array_contains(nulls, c), F.lit(False))
        for name, holds in (("sure", sure), ("maybe", maybe)):
            aggs.append(F.max_by(F.struct(F.col(c).alias("v")), F.when(holds & sets, F.col(seq))).alias(f"__{name}_{c}"))
    last = marked.groupBy(*keys).agg(*aggs).withColumnsRenamed({k: f"__k_{k}" for k in keys})
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        on = same if on is None else on & same
    old = target.withColumn("__old", F.lit(True))
    both = old.join(last, on, "full")
    was = F.col("__old").isNotNull()
    keep = F.when(F.col("__op").isNull(), was).otherwise(F.col("__op") == "add")

    def value(c: str) -> Column:
        base = F.when(F.col("__deleted").isNull(), F.col(c))
        if c not in given:
            return base.alias(c)
        new = F.when(was, F.col(f"__maybe_{c}")).otherwise(F.col(f"__sure_{c}"))
        return F.when(new.isNotNull(), new["v"]).otherwise(base).alias(c)

    key_cols = [F.when(was, F.col(k)).otherwise(F.col(f"__k_{k}")).alias(k) for k in keys]
    return both.where(keep).select(*key_cols, *[value(c) for c in cols]).select(*target.columns)
