"""Batch readers.  Schemas are always given, never inferred."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas

#: Fixed value: name of a day's folder.
SHARD = r"data_(\d{8})"


def scan_raw(
    spark: SparkSession,
    path: str,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    hole: str | None = None,
    schema: T.StructType = schemas.RAW,
) -> DataFrame:
    """Raw rows of a date range; `date` and `hole` are partition columns, so the range prunes files."""
    df = spark.read.schema(schema).parquet(path)
    if date_from is not None:
        df = df.where(F.col("date") >= F.lit(date_from))
    if date_to is not None:
        df = df.where(F.col("date") <= F.lit(date_to))
    return df if hole is None else df.where(F.col("hole") == hole)


def shard_days(spark: SparkSession, root: str, date_from: dt.date | None = None, date_to: dt.date | None = None) -> list[str]:
    """Folders `data_YYYYMMDD` of a span of days, by their names alone; other names are passed over."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []
    low = f"{date_from or dt.date.min:%Y%m%d}".rjust(8, "0")
    high = f"{date_to or dt.date.max:%Y%m%d}".rjust(8, "0")
    return sorted(f"{root.rstrip('/')}/{n}" for n in names if re.fullmatch(SHARD, n) and low <= n[-8:] <= high)


def scan_shards(
    spark: SparkSession, root: str, date_from: dt.date | None = None, date_to: dt.date | None = None, schema: T.StructType = schemas.RAW
) -> DataFrame:
    """Raw rows of date-named folders; only folders of the span are listed and read, and `date` is
    that of the folder a row lies in, whatever its file says. Without a folder there are no rows."""
    folders = shard_days(spark, root, date_from, date_to)
    if not folders:
        return spark.createDataFrame([], schema)
    inside = T.StructType([f for f in schema.fields if f.name != "date"])
    day = F.to_date(F.regexp_extract("_metadata.file_path", rf"/{SHARD}/[^/]*$", 1), "yyyyMMdd")
    return spark.read.schema(inside).parquet(*folders).withColumn("date", day).select(*schema.fieldNames())


def raw_detail(df: DataFrame, date: dt.date, hole: str) -> DataFrame:
    """One venue and day, by model and unit."""
    return df.where((F.col("date") == F.lit(date)) & (F.col("hole") == hole)).orderBy("machine", "machine_number")


def scan_mart(
    spark: SparkSession, path: str, date_from=None, date_to=None, hole=None, machine=None, played: bool = False
) -> DataFrame:
    df = spark.read.schema(schemas.MART).parquet(path)
    if date_from is not None:
        df = df.where(F.col("target_date") >= F.lit(date_from))
    if date_to is not None:
        df = df.where(F.col("target_date") <= F.lit(date_to))
    if hole is not None:
        df = df.where(F.col("hole") == hole)
    if machine is not None:
        df = df.where(F.col("machine") == machine)
    return df.where(F.col("d1_game") > 0) if played else df


def load_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; a missing file gives no rows."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.globStatus(fs_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """Layout documents, one JSON file each, with the file they came from."""
    df = spark.read.schema(schemas.LAYOUT).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return df.withColumn("file", F.input_file_name())


def layout_floors(layouts: DataFrame) -> DataFrame:
    """Floors per venue."""
    return layouts.groupBy("hole").agg(F.array_sort(F.collect_set("floor")).alias("floors"))
