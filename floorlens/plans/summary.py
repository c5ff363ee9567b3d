"""Period summaries of observations: heatmap, condition summary, unit statistics."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import fixed
from ..functions.scalars import payout, safe_div
from ..operators.dedupe import dedupe_latest
from ..operators.remap import remap_units
from ..sources import schemas
from .mart import LOOKBACK_DAYS, build_mart


@dataclass(frozen=True)
class SpecialFilter:
    """Special-day filter: a day counts when ANY given condition holds.

    The texts are lists by containment ('土日', '週末,祝日', '068').
    """

    enabled: bool = False
    day_of_week: str | None = None
    day_type: str | None = None
    last_digit: str | None = None
    month_eq_day: bool | None = None
    double_digit: bool | None = None

    def condition(self, date: Column, holiday: Column) -> Column:
        if not self.enabled:
            return F.lit(True)

        def listed(text, value):
            return F.contains(F.lit(text).cast("string"), value.cast("string"))

        hits = [
            listed(self.day_of_week, cal.weekday_label(date)),
            listed(self.day_type, cal.day_type(date, holiday)),
            listed(self.last_digit, cal.last_digit(F.dayofmonth(date))),
            cal.month_day_match(date) & F.lit(self.month_eq_day).cast("boolean"),
            cal.day_repdigit(date) & F.lit(self.double_digit).cast("boolean"),
        ]
        out = F.lit(False)
        for h in hits:
            out = out | F.coalesce(h, F.lit(False))  # a NULL parameter matches nothing
        return out


def played() -> Column:
    return F.col("game").isNotNull() & (F.col("game") > 0)


def in_period(df: DataFrame, date_from, date_to, hole=None, date: str = "date") -> DataFrame:
    """Partition filter on the date, optionally one venue."""
    if date_from is not None:
        df = df.where(F.col(date) >= F.lit(date_from))
    if date_to is not None:
        df = df.where(F.col(date) <= F.lit(date_to))
    return df if hole is None else df.where(F.col("hole") == hole)


def heatmap(
    raw: DataFrame,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    hole: str | None = None,
    special: SpecialFilter = SpecialFilter(),
    holidays: DataFrame | None = None,
    mapping: DataFrame | None = None,
    shifts=(),
    ts: str = "timestamp",
    ties: list[str] = (),
) -> DataFrame:
    """Averages per unit and model over the period; the latest model of each unit.

    Newest copy per id first, played rows after that.  Models whose last dates
    tie are all kept.
    """
    rows = in_period(raw, date_from, date_to, hole)
    rows = rows.select(
        *dict.fromkeys(["id", "date", "hole", "machine", "machine_number", "diff", "game", "win", ts, *ties])
    )
    newest = dedupe_latest(rows, ["id"], ts, ties).where(played())
    days = cal.with_holiday_flag(remap_units(newest, mapping, shifts), "date", holidays)
    kept = days.where(special.condition(F.col("date"), F.col("is_holiday")))
    n = F.count(F.lit(1))
    agg = kept.groupBy("hole", "machine", "machine_number").agg(
        safe_div(F.sum("diff"), n).alias("avg_diff"),
        safe_div(F.sum("win"), n).alias("win_rate"),
        F.min("date").alias("date_from"),
        F.max("date").alias("date_to"),
        payout(F.sum("game"), F.sum("diff")).alias("payout_rate"),
    )
    # after the aggregation a unit has one row per model it ever held
    last = F.max("date_to").over(Window.partitionBy("hole", "machine_number"))
    return agg.withColumn("__last", last).where("date_to = __last").drop("__last")


def _conditions() -> Column:
    """The (type, value) pairs a row counts under."""

    def pair(kind, value, when=None):
        s = F.struct(F.lit(kind).alias("condition_type"), value.alias("condition_value"))
        return s if when is None else F.when(when, s)

    def flag(label, column):
        return pair(label[0], F.lit(label[1]), F.col(column))

    every = [
        pair(fixed.COND_ALL[0], F.lit(fixed.COND_ALL[1])),
        pair(fixed.COND_WEEKDAY, F.col("day_of_week")),
        pair(fixed.COND_DAY_TYPE, F.col("day_type")),
        pair(fixed.COND_LAST_DIGIT, F.concat(F.col("last_digit"), F.lit("のつく日"))),
        flag(fixed.COND_REPDIGIT, "is_day_repdigit"),
        flag(fixed.COND_MONTH_DAY, "is_month_day_match"),
        flag(fixed.COND_ANNIVERSARY, "is_anniversary"),
        flag(fixed.COND_FIRST_DAY, "is_first_day"),
        flag(fixed.COND_LAST_DAY, "is_last_day"),
    ]
    return F.array_compact(F.array(*every))


def condition_summary(
    raw: DataFrame,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    hole: str | None = None,
    holidays: DataFrame | None = None,
    mapping: DataFrame | None = None,
    ts: str = "timestamp",
    ties: list[str] = (),
) -> DataFrame:
    """Twelve measures per model under nine families of calendar conditions.

    Played rows first, newest copy per id after that.  Rows are summed per
    (venue, model, day) before they are multiplied by the conditions: all
    conditions depend on the day alone, so the explode works on day totals and
    the distinct-day count becomes a plain count.
    """
    rows = in_period(raw, date_from, date_to, hole).where(played())
    rows = rows.select(*dict.fromkeys(["id", "date", "hole", "machine", "diff", "game", "win", ts, *ties]))
    newest = dedupe_latest(rows, ["id"], ts, ties)
    per_day = newest.groupBy("hole", "machine", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("diff").alias("diff"),
        F.sum("game").alias("game"),
        F.sum("win").alias("win"),
    )
    flagged = cal.with_holiday_flag(per_day, "date", holidays)
    flagged = flagged.withColumns(cal.summary_calendar(F.col("date"), F.col("is_holiday")))
    spread = flagged.withColumn("c", F.explode(_conditions()))
    n, diff, game = F.sum("n"), F.sum("diff"), F.sum("game")
    return spread.groupBy("c.condition_type", "c.condition_value", "hole", "machine").agg(
        F.min("date").alias("period_from"),
        F.max("date").alias("period_to"),
        F.count(F.lit(1)).alias("sample_days"),
        n.alias("sample_units"),
        diff.alias("total_diff"),
        safe_div(diff, n).alias("avg_diff"),
        game.alias("total_game"),
        safe_div(F.sum("win"), n).alias("win_rate"),
        payout(game, diff).alias("payout_rate"),
    )


def latest_dates(mart: DataFrame, keys: list[str]) -> DataFrame:
    return mart.groupBy(*keys).agg(F.max("target_date").alias("latest_date"))


def resolve_target_date(mart: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Asked target date, else the day after the latest data of the key."""
    latest = latest_dates(mart, keys)
    return params.join(latest, keys).withColumn(
        "calc_target_date", F.coalesce(F.col("target_date"), F.date_add("latest_date", 1))
    )


def unit_statistics(mart: DataFrame, at: dt.date | None = None, hole: str | None = None) -> DataFrame:
    """Windows including the day itself, per unit of a venue at a date.

    Without a date each venue is shown at its latest one.
    """
    rows = mart if hole is None else mart.where(F.col("hole") == hole)
    if at is not None:
        rows = rows.where(F.col("target_date") == F.lit(at))
    else:
        newest = latest_dates(rows, ["hole"]).withColumnRenamed("latest_date", "target_date")
        rows = rows.join(newest, ["hole", "target_date"], "left_semi")
    return rows.select(*_statistics())


def _statistics() -> list[str]:
    head = ["hole", "machine_number", "machine", "target_date", "start_date", "end_date"]
    return head + [n for p in schemas.WINDOW_PREFIXES for n, _ in schemas.window_columns(p)]


def latest_unit_statistics(raw: DataFrame, lookback: int = LOOKBACK_DAYS, **mart_args) -> DataFrame:
    """`unit_statistics` of each venue's latest day, straight from raw rows.

    The latest days come from the raw keys; windows are built over the days behind them
    only, so the history is neither deduplicated nor windowed.
    """
    newest = raw.groupBy("hole").agg(F.max("date").alias("__latest"))
    near = raw.join(newest, "hole").where(F.col("date") > F.date_sub("__latest", lookback)).drop("__latest")
    rows = build_mart(near, lookback=lookback, **mart_args)
    rows = rows.join(newest.withColumnRenamed("__latest", "target_date"), ["hole", "target_date"], "left_semi")
    return rows.select(*_statistics())


def overlay_layout(layouts: DataFrame, stats: DataFrame) -> DataFrame:
    """Layout cells with the statistics of the unit that stands in them."""
    cells = layouts.select("hole", "floor", F.explode("cells").alias("cell")).select("hole", "floor", "cell.*")
    s = stats.withColumnRenamed("machine_number", "number")
    return cells.join(s, ["hole", "number"], "left")


def mart_breakdown(mart: DataFrame, by: str) -> DataFrame:
    """Rows, mean diff, mean payout and win rate by a calendar column."""
    return mart.groupBy(by).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg("d1_diff").alias("avg_diff"),
        F.avg("d1_payout_rate").alias("avg_payout_rate"),
        F.avg(F.when(F.col("d1_diff") > 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("win_rate"),
    )


def rising_units(mart: DataFrame) -> DataFrame:
    """Units whose payout rises from 28 to 14 to 7 days."""
    return mart.where("d7_payout_rate > d14_payout_rate and d14_payout_rate > d28_payout_rate").select(
        "target_date",
        "hole",
        "machine_number",
        "machine",
        F.col("d7_payout_rate").alias("short_term"),
        F.col("d14_payout_rate").alias("mid_term"),
        F.col("d28_payout_rate").alias("long_term"),
    )


def steady_winners(mart: DataFrame, floor: float = 0.5) -> DataFrame:
    """Units at or above a win rate both with and without the day itself."""
    ok = (F.col("d2_win_rate") >= floor) & (F.col("prev_d2_win_rate") >= floor)
    return mart.where(ok).select("target_date", "hole", "machine_number", "machine", "d2_win_rate", "prev_d2_win_rate")
