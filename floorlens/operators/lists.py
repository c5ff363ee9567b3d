"""Filtered lists and small dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.scalars import order_label


def list_rows(
    df: DataFrame,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    holes: list[str] | None = None,
    equals: dict[str, object] | None = None,
    newest: list[str] = ("date",),
    limit: int | None = None,
) -> DataFrame:
    """Rows by date range, venues and column values, newest first.

    With a limit Spark plans a top-k, which keeps k rows per task.
    """
    if date_from is not None:
        df = df.where(F.col("date") >= F.lit(date_from))
    if date_to is not None:
        df = df.where(F.col("date") <= F.lit(date_to))
    if holes:
        df = df.where(F.col("hole").isin(list(holes)))
    for c, v in (equals or {}).items():
        df = df.where(F.col(c) == v)
    df = df.orderBy(*[F.col(c).desc() for c in newest])
    return df if limit is None else df.limit(limit)


def rows_per_date(df: DataFrame, date_from: dt.date, date_to: dt.date) -> DataFrame:
    kept = df.where(F.col("date").between(F.lit(date_from), F.lit(date_to)))
    return kept.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).select(col).distinct()


def event_types(df: DataFrame) -> DataFrame:
    """Master list in display order."""
    return df.orderBy(F.coalesce("sort_order", F.lit(0)), "name")


def venues(
    df: DataFrame,
    active: bool = True,
    priority: str | None = None,
    region: str | None = None,
    late_update: bool | None = None,
) -> DataFrame:
    if active:
        df = df.where("active")
    if priority is not None:
        df = df.where(F.col("priority") == priority)
    if region is not None:
        df = df.where(F.col("region") == region)
    if late_update is not None:
        df = df.where(F.col("late_update") == late_update)
    return df


def by_priority(df: DataFrame) -> DataFrame:
    """High before normal before low."""
    return df.withColumn("priority_order", order_label(F.col("priority"), fixed.PRIORITY_ORDER) - 1).orderBy(
        "priority_order", "name"
    )


def with_venue_code(df: DataFrame, venues: DataFrame) -> DataFrame:
    """Adds the venue code by name."""
    return df.join(venues.select(F.col("name").alias("hole"), F.col("code").alias("hole_code")), "hole", "left")


def events_from_dates(dates: DataFrame, hole: str, event: str) -> DataFrame:
    """Event rows for a list of dates, with an id derived from the key."""
    key = F.concat_ws("_", F.col("date").cast("string"), F.lit(hole), F.lit(event))
    return dates.select(
        F.sha2(key, 256).alias("id"), "date", F.lit(hole).alias("hole"), F.lit(event).alias("event")
    ).distinct()
