"""Duplicate handling.

`row_number() == 1` is planned with a partial WindowGroupLimit before the
exchange: every map task forwards at most one row per key, so a key with a huge
number of copies never reaches one reducer in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dedupe_latest(df: DataFrame, keys: list[str], ts: str = "timestamp", ties: list[str] = ()) -> DataFrame:
    """Newest row per key; `ties` make the order total."""
    return _first_by(df, keys, [F.col(c).desc_nulls_last() for c in [ts, *ties]])


def dedupe_first(df: DataFrame, keys: list[str], seq: str, ties: list[str] = ()) -> DataFrame:
    """First inserted row per key."""
    return _first_by(df, keys, [F.col(c).asc_nulls_first() for c in [seq, *ties]])


def dedupe_collapse(df: DataFrame, key: str = "id", ts: str = "timestamp", ties: list[str] = ()) -> DataFrame:
    """One row per id that carries the earliest timestamp.

    Any row's values would do; taking them from the earliest row makes the
    result repeatable.
    """
    return dedupe_first(df, [key], ts, ties)


def duplicate_report(df: DataFrame, by: list[str], key: str = "id") -> DataFrame:
    """Rows, distinct keys and their difference per group.

    Counted in two steps: copies are first summed per key with map-side partial
    aggregation, then the keys are counted, so no group's ids meet in one task.
    """
    per_key = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*by).agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("unique_count"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_count"),
        (F.sum("n") > F.count(F.lit(1))).alias("has_duplicates"),
    )
