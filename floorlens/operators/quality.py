"""Data-quality reports: completeness, mart status, failures, corrections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def collection_status(
    raw: DataFrame, venues: DataFrame, date_from: dt.date, date_to: dt.date, ts: str = "timestamp"
) -> DataFrame:
    """Rows and last update per day and venue.

    Every active venue has a row for every day, days without data included; venues
    that are inactive or not listed have rows where they have data.
    """
    have = (
        raw.where(F.col("date").between(F.lit(date_from), F.lit(date_to)))
        .groupBy("date", "hole")
        .agg(F.count(F.lit(1)).alias("rows"), F.max(ts).alias("last_updated"))
    )
    active = venues.where("active").select(F.col("name").alias("hole"))
    every_day = F.sequence(F.lit(date_from), F.lit(date_to), F.expr("interval 1 day"))
    grid = active.withColumn("date", F.explode(every_day))
    grid = grid.select("date", "hole", F.lit(True).alias("active"))
    listed = venues.select(F.col("name").alias("hole"), "region", "late_update")
    return (
        grid.join(have, ["date", "hole"], "full")
        .join(listed, "hole", "left")
        .select(
            "date",
            "hole",
            "region",
            F.coalesce("late_update", F.lit(False)).alias("late_update"),
            F.coalesce("active", F.lit(False)).alias("active"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
            "last_updated",
        )
    )


def collection_days(status: DataFrame) -> DataFrame:
    """Completeness of each day: late-reporting venues and all venues."""
    have = F.col("rows") > 0
    return status.groupBy("date").agg(
        F.sum("rows").alias("total_count"),
        F.count_if(have).alias("acquired_count"),
        F.count_if("active").alias("total_venues"),
        F.coalesce(F.bool_and(F.when(F.col("late_update") & F.col("active"), have)), F.lit(True)).alias("priority_complete"),
        F.coalesce(F.bool_and(F.when(F.col("active"), have)), F.lit(True)).alias("all_complete"),
    )


def collection_summary(days: DataFrame) -> DataFrame:
    return days.agg(
        F.count(F.lit(1)).alias("total_dates"),
        F.count_if("priority_complete").alias("priority_complete_dates"),
        F.count_if("all_complete").alias("all_complete_dates"),
    )


def mart_status(mart: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """Rows, wins and mean diff per (date, venue), per date and overall.

    `level` tells them apart: venue, date, total.
    """
    if date_from is not None:
        mart = mart.where(F.col("target_date") >= F.lit(date_from))
    if date_to is not None:
        mart = mart.where(F.col("target_date") <= F.lit(date_to))
    agg = mart.rollup("target_date", "hole").agg(
        F.grouping_id().alias("__g"),
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("d1_diff") > 0).alias("win_count"),
        F.round(F.coalesce(F.avg("d1_diff"), F.lit(0.0)), 0).alias("avg_diff"),
    )
    level = F.when(F.col("__g") == 0, "venue").when(F.col("__g") == 1, "date").otherwise("total")
    return agg.select("target_date", "hole", level.alias("level"), "count", "win_count", "avg_diff")


def model_count(raw: DataFrame) -> DataFrame:
    """Distinct models per (date, venue), counted in two steps."""
    return raw.groupBy("date", "hole", "machine").agg(F.lit(1).alias("x")).groupBy("date", "hole").agg(
        F.count("machine").alias("models")
    )


def has_data(keys: DataFrame, raw: DataFrame) -> DataFrame:
    """Whether each (date, venue) has rows."""
    present = raw.select("date", "hole").distinct().withColumn("__p", F.lit(True))
    return keys.join(present, ["date", "hole"], "left").withColumn("exists", F.col("__p").isNotNull()).drop("__p")


def row_count_by_venue(raw: DataFrame) -> DataFrame:
    """Distinct ids per venue; ids are reduced first, so no venue's ids meet in one task."""
    return raw.select("hole", "id").distinct().groupBy("hole").agg(F.count(F.lit(1)).alias("n"))


def failure_stats(failures: DataFrame) -> DataFrame:
    """Count per status, zero included, and the total, in one row."""
    return failures.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in fixed.FAILURE_STATUSES], F.count(F.lit(1)).alias("total")
    )


def pending_failures(failures: DataFrame) -> DataFrame:
    return failures.where("status = 'pending'").groupBy("date", "hole").agg(F.count(F.lit(1)).alias("pending"))


def corrections_summary(corrections: DataFrame) -> DataFrame:
    """Corrections per (date, venue, model) with first and last stamp and the latest note."""
    return corrections.groupBy("date", "hole", "machine").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("corrected_at").alias("first_corrected"),
        F.max("corrected_at").alias("last_corrected"),
        F.max_by("notes", F.struct("corrected_at", "notes")).alias("notes"),
    )
