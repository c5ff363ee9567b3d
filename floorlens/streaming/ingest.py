"""Streaming ingest and incremental mart refresh.

New raw files are cleaned, the newest copy of each unit-day replaces the stored
one, and only the mart days that can have changed are rebuilt.  A batch is merged
by key with the partitions it touches, and the merged rows are kept beside the
table until the exchange is complete, so a batch that is replayed after a failure
gives the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import dedupe_latest
from ..plans.mart import LOOKBACK_DAYS, build_mart
from ..sources import schemas, sinks


def read_stream(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW, files_per_trigger: int | None = None):
    """File stream of raw rows."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def drop_repeats(stream: DataFrame, keys: list[str], ts: str = "timestamp", delay: str = "3 days") -> DataFrame:
    """Drops exact repeats that arrive within the delay; state older than the watermark is removed."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def merge_batch(
    batch: DataFrame, path: str, keys: list[str], by: list[str], schema: T.StructType, ts: str = "timestamp"
) -> None:
    """Keeps, per key, the newest of the stored and the arriving rows."""
    spark = batch.sparkSession
    rows = batch.select(*[f.name for f in schema.fields])
    sinks.recover(spark, path, by, schema)
    if sinks.exists(spark, path):
        rows = rows.unionByName(sinks.touched_partitions(spark, rows, path, by, schema))
    # after ts the remaining columns only make the order total
    ties = [f.name for f in schema.fields if f.name not in (ts, *keys)]
    sinks.commit_merged(dedupe_latest(rows, keys, ts, ties), path, by)


def affected_intervals(batch: DataFrame, lookback: int = LOOKBACK_DAYS) -> list[tuple[dt.date, dt.date]]:
    """Target dates whose windows can contain a row of the batch, as separate intervals.

    A late row of an old day adds the month behind that day, not all days up to now.
    The batch's distinct dates are collected: one value a day.
    """
    dates = sorted(r[0] for r in batch.select("date").distinct().collect() if r[0] is not None)
    out: list[tuple[dt.date, dt.date]] = []
    for day in dates:
        end = day + dt.timedelta(days=lookback - 1)
        if out and day <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = out[-1][0], end
        else:
            out.append((day, end))
    return out


def _within(column: str, intervals: list[tuple[dt.date, dt.date]], before: int = 0):
    days = F.lit(False)
    for low, high in intervals:
        days = days | F.col(column).between(F.lit(low - dt.timedelta(days=before)), F.lit(high))
    return days


def refresh_intervals(
    spark: SparkSession,
    raw_path: str,
    mart_path: str,
    intervals: list[tuple[dt.date, dt.date]],
    raw_schema: T.StructType = schemas.RAW,
    lookback: int = LOOKBACK_DAYS,
    **mart_args,
) -> sinks.UpsertResult:
    """Rebuilds the target dates of all intervals in one job and upserts them.

    Raw rows are read for the intervals and the lookback before each, as a literal filter
    on the partition column.
    """
    raw = spark.read.schema(raw_schema).parquet(raw_path).where(_within("date", intervals, lookback - 1))
    rows = build_mart(raw, lookback=lookback, **mart_args).where(_within("target_date", intervals))
    return sinks.upsert(spark, rows, mart_path, schemas.MART_KEYS, ["target_date"], schemas.MART)


def refresh_mart(
    spark: SparkSession,
    raw_path: str,
    mart_path: str,
    date_from: dt.date,
    date_to: dt.date,
    raw_schema: T.StructType = schemas.RAW,
    replace: bool = False,
    **mart_args,
) -> sinks.UpsertResult | None:
    """Rebuilds target dates in one job.

    By default rows are upserted and units that disappeared keep their old rows;
    replace=True overwrites whole days.
    """
    raw = spark.read.schema(raw_schema).parquet(raw_path)
    rows = build_mart(raw, date_from, date_to, **mart_args)
    if replace:
        sinks.overwrite_partitions(rows, mart_path, ["target_date"])
        return None
    return sinks.upsert(spark, rows, mart_path, schemas.MART_KEYS, ["target_date"], schemas.MART)


def ingest(
    stream: DataFrame,
    raw_path: str,
    checkpoint: str,
    mart_path: str | None = None,
    keys: tuple[str, ...] = ("date", "hole", "machine_number", "source"),
    schema: T.StructType = schemas.RAW,
    repeat_delay: str | None = None,
    ledger: str | None = None,
    ts: str = "timestamp",
    by: tuple[str, ...] = ("date", "hole"),
    **mart_args,
):
    """Starts the ingest of all available files and returns the query.

    The checkpoint belongs in storage that all executors and a restarted driver
    can reach.

    With `repeat_delay`, rows that repeat a key and stamp within that time of the newest stamp
    are dropped before they are merged: the keys are the state of the stream, kept with the
    checkpoint and removed as the watermark passes them. Rows later than the watermark are
    dropped too; without `repeat_delay` there is no state and late rows are merged.

    `ledger` is a table of what each batch brought: rows for each day and venue. A batch that
    is replayed replaces its own entry. `by` are the partition columns of the raw table: where the
    venues are many, days alone make folders of a fair size.
    """
    if repeat_delay is not None:
        stream = drop_repeats(stream, list(keys), ts, repeat_delay)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if ledger is not None:
            entry = batch.groupBy("date", "hole").agg(F.count(F.lit(1)).alias("rows")).withColumn("batch_id", F.lit(batch_id))
            sinks.overwrite_partitions(entry, ledger, ["batch_id"])
        merge_batch(batch, raw_path, list(keys), list(by), schema)
        if mart_path is None:
            return
        intervals = affected_intervals(batch)
        if intervals:
            refresh_intervals(spark, raw_path, mart_path, intervals, raw_schema=schema, **mart_args)

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
