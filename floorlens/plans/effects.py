"""Effect studies over the mart: day category, streak, both, and the tier list.

The studies run for every (venue, model) at once or for one of them.  Baselines
come from the same pass: group totals are added up again by a window over the
few result rows instead of reading the mart twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import fixed
from ..functions.scalars import order_label, safe_div, win_flag
from .summary import in_period, latest_dates

_STUDY = ["hole", "machine"]


def study_rows(mart: DataFrame, hole=None, machine=None, date_from=None, date_to=None) -> DataFrame:
    """Played mart rows of the study with the win flag."""
    rows = in_period(mart, date_from, date_to, hole, date="target_date").where(
        F.col("d1_game").isNotNull() & (F.col("d1_game") > 0)
    )
    if machine is not None:
        rows = rows.where(F.col("machine") == machine)
    return rows.select(
        *_STUDY,
        "target_date",
        "d1_diff",
        "d1_game",
        "d1_payout_rate",
        *[f"prev_d{n}_win_rate" for n in fixed.STREAK_DAYS],
        win_flag(F.col("d1_diff")).alias("win"),
    )


def with_category(df: DataFrame, events: DataFrame, date: str = "target_date", collapse_events: bool = True, event_types=None) -> DataFrame:
    """Adds day_category.

    With collapse_events a day with several events counts its rows once; without
    it the rows are repeated per event.
    """
    if event_types is not None:
        events = events.where(F.col("event").isin(list(event_types)))
    e = events.where(F.col("event").isNotNull()).select(F.col("date").alias("__d"), F.col("hole").alias("__hole"))
    if collapse_events:
        e = e.distinct()
    on = (df[date] == F.col("__d")) & (df["hole"] == F.col("__hole"))
    joined = df.join(e, on, "left")
    return joined.withColumn("day_category", cal.day_category(F.col(date), F.col("__d").isNotNull())).drop("__d", "__hole")


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("sample_count"),
        F.avg("d1_diff").alias("avg_diff"),
        F.avg("d1_payout_rate").alias("avg_payout_rate"),
        F.avg("win").alias("avg_win_rate"),
        F.stddev_samp("d1_payout_rate").alias("stddev_payout_rate"),
        # totals behind the averages, for the baseline
        F.sum("d1_payout_rate").alias("__pay"),
        F.count("d1_payout_rate").alias("__pays"),
        F.sum("win").alias("__win"),
    ]


def _rounded(*extra: str) -> list[Column]:
    return [
        F.round("avg_diff", 0).alias("avg_diff"),
        *[F.col(c) for c in extra],
        F.round("avg_payout_rate", 4).alias("avg_payout_rate"),
        F.round("avg_win_rate", 4).alias("avg_win_rate"),
        F.round("stddev_payout_rate", 4).alias("stddev_payout_rate"),
        F.round(F.col("avg_payout_rate") - F.col("__base_pay"), 4).alias("vs_baseline_payout"),
        F.round(F.col("avg_win_rate") - F.col("__base_win"), 4).alias("vs_baseline_win"),
    ]


def _with_baseline(agg: DataFrame, rows: Column) -> DataFrame:
    """Study means from the totals of the result rows selected by `rows`."""
    w = Window.partitionBy(*_STUDY)

    def total(c):
        return F.sum(F.when(rows, F.col(c))).over(w)

    return agg.withColumns(
        {
            "__base_pay": safe_div(total("__pay"), total("__pays")),
            "__base_win": safe_div(total("__win"), total("sample_count")),
        }
    )


def baseline(mart: DataFrame, **study) -> DataFrame:
    return study_rows(mart, **study).groupBy(*_STUDY).agg(
        F.avg("d1_payout_rate").alias("baseline_payout_rate"), F.avg("win").alias("baseline_win_rate")
    )


def day_category_effect(mart: DataFrame, events: DataFrame, collapse_events: bool = True, event_types=None, **study) -> DataFrame:
    rows = with_category(study_rows(mart, **study), events, collapse_events=collapse_events, event_types=event_types)
    # per day first: distinct days become a count; map-side partials keep hot categories small
    agg = rows.groupBy(*_STUDY, "day_category").agg(
        F.countDistinct("target_date").alias("sample_days"), F.sum("d1_game").alias("total_game"), *_sums()
    )
    full = _with_baseline(agg, F.lit(True))
    return full.select(
        *_STUDY,
        "day_category",
        "sample_days",
        F.col("sample_count").alias("sample_records"),
        *_rounded("total_game"),
        order_label(F.col("day_category"), fixed.CATEGORY_ORDER[:-1]).alias("sort_order"),
    )


def _streaks() -> Column:
    """Streak labels of a row, after an empty one that counts every row once."""
    labels = [F.struct(F.lit(0).alias("days"), F.lit("").alias("pattern"))]
    for n in fixed.STREAK_DAYS:
        label = cal.streak_label(n, F.col(f"prev_d{n}_win_rate"))
        labels.append(F.when(label.isNotNull(), F.struct(F.lit(n).alias("days"), label.alias("pattern"))))
    return F.array_compact(F.array(*labels))


_PATTERNS = [f(n) for n in fixed.STREAK_DAYS for f in (fixed.wins, fixed.losses)]


def streak_effect(mart: DataFrame, **study) -> DataFrame:
    rows = study_rows(mart, **study).withColumn("s", F.explode(_streaks()))
    agg = rows.groupBy(*_STUDY, "s.days", "s.pattern").agg(*_sums())
    full = _with_baseline(agg, F.col("days") == 0).where("days > 0")
    period = F.concat(F.col("days").cast("string"), F.lit(fixed.period_label("")))
    first = order_label(F.col("pattern"), _PATTERNS)
    return full.select(
        *_STUDY,
        period.alias("period"),
        F.col("pattern").alias("streak_pattern"),
        "sample_count",
        *_rounded(),
        order_label(F.col("days"), fixed.STREAK_DAYS).alias("period_order"),
        (F.pmod(first - 1, F.lit(2)) + 1).alias("pattern_order"),
    )


def combined_effect(mart: DataFrame, events: DataFrame, collapse_events: bool = True, event_types=None, **study) -> DataFrame:
    """Category x streak, and every streak over all days, in one grouping."""
    rows = with_category(study_rows(mart, **study), events, collapse_events=collapse_events, event_types=event_types)
    spread = rows.withColumn("s", F.explode(_streaks())).withColumn("pattern", F.col("s.pattern"))
    agg = spread.groupingSets(
        [["hole", "machine", "day_category", "pattern"], ["hole", "machine", "pattern"]],
        "hole",
        "machine",
        "day_category",
        "pattern",
    ).agg(F.grouping("day_category").alias("__all"), *_sums())
    agg = agg.withColumn("day_category", F.when(F.col("__all") == 1, fixed.CAT_ALL).otherwise(F.col("day_category")))
    full = _with_baseline(agg, (F.col("__all") == 1) & (F.col("pattern") == "")).where("pattern <> ''")
    return full.select(
        *_STUDY,
        "day_category",
        F.col("pattern").alias("streak_pattern"),
        "sample_count",
        *_rounded(),
        order_label(F.col("day_category"), fixed.CATEGORY_ORDER).alias("day_sort"),
        order_label(F.col("pattern"), _PATTERNS).alias("streak_sort"),
    )


def tier_recommendation(
    mart: DataFrame,
    events: DataFrame,
    target_date=None,
    hole=None,
    machine=None,
    current_streak: bool = False,
    event_types=None,
) -> DataFrame:
    """Units worth picking on the target date (default: day after the latest data).

    As published, the streak is the one before the latest day; current_streak
    takes the one that includes it.
    """
    rows = mart
    if hole is not None:
        rows = rows.where(F.col("hole") == hole)
    if machine is not None:
        rows = rows.where(F.col("machine") == machine)
    feature = "d{}_win_rate" if current_streak else "prev_d{}_win_rate"
    rows = rows.select(
        *_STUDY, "machine_number", "target_date", *[F.col(feature.format(n)).alias(f"r{n}") for n in fixed.STREAK_DAYS]
    )
    latest = latest_dates(rows, _STUDY)
    newest = rows.join(latest, _STUDY).where("target_date = latest_date").drop("target_date")
    asked = F.lit(target_date).cast("date")
    newest = newest.withColumn("target_date", F.coalesce(asked, F.date_add("latest_date", 1)))
    days = with_category(newest, events, event_types=event_types)
    days = days.withColumns({f"d{n}_pattern": cal.streak_label(n, F.col(f"r{n}")) for n in fixed.STREAK_DAYS})
    rank, text = cal.tier(F.col("day_category"), {n: F.col(f"d{n}_pattern") for n in fixed.STREAK_DAYS})
    return (
        days.withColumns({"priority_rank": rank, "strategy_name": text})
        .where("priority_rank > 0")
        .select(
            "target_date",
            F.col("latest_date").alias("data_latest_date"),
            *_STUDY,
            "day_category",
            "machine_number",
            "priority_rank",
            "strategy_name",
            *[F.round(f"r{n}", 2).alias(f"d{n}_win_rate") for n in fixed.STREAK_DAYS],
            *[f"d{n}_pattern" for n in fixed.STREAK_DAYS],
        )
    )
