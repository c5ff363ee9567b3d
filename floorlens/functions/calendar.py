"""Calendar columns, day categories, special days and digit features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed


def day_num(date: Column) -> Column:
    """Days since 1970-01-01: the integer order key of range windows."""
    return F.unix_date(date)


def calendar(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date") -> DataFrame:
    """Every day from start to end, both included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias(name)
    )


def relative_dates(spark: SparkSession, today: dt.date, frm: int, to: int) -> DataFrame:
    """Days from `frm` days ago to `to` days ago, oldest first, in either order."""
    old, new = max(frm, to), min(frm, to)
    return calendar(spark, today - dt.timedelta(days=old), today - dt.timedelta(days=new))


def weekday_label(date: Column) -> Column:
    names = F.array(*[F.lit(n) for n in fixed.WEEKDAYS_FROM_SUNDAY])
    return F.element_at(names, F.dayofweek(date))


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def day_type(date: Column, holiday: Column, summary: bool = False) -> Column:
    """Weekend, then holiday, then weekday; the summary form merges the first two."""
    off, hol = (fixed.DAY_OFF, fixed.DAY_OFF) if summary else (fixed.WEEKEND, fixed.HOLIDAY)
    return F.when(is_weekend(date), off).when(holiday, hol).otherwise(fixed.WEEKDAY)


def month_day_match(date: Column, summary: bool = False) -> Column:
    """Month equals day; the summary form also takes 1/11, 2/22."""
    m, d = F.month(date), F.dayofmonth(date)
    return ((m == d) | (m * 11 == d)) if summary else (m == d)


def day_repdigit(date: Column) -> Column:
    return F.dayofmonth(date).isin(11, 22)


def month_end(date: Column) -> Column:
    return date == F.last_day(date)


def last_digit(n: Column) -> Column:
    return F.pmod(n, F.lit(10))


def mart_calendar(date: Column, holiday: Column) -> dict[str, Column]:
    return {
        "target_year": F.year(date).cast("bigint"),
        "target_month": F.month(date).cast("bigint"),
        "target_day": F.dayofmonth(date).cast("bigint"),
        "target_day_last_digit": last_digit(F.dayofmonth(date)).cast("bigint"),
        "is_month_day_repdigit": month_day_match(date),
        "is_day_repdigit": day_repdigit(date),
        "day_of_week_jp": weekday_label(date),
        "day_type": day_type(date, holiday),
    }


def summary_calendar(date: Column, holiday: Column) -> dict[str, Column]:
    return {
        "day_of_week": weekday_label(date),
        "day_type": day_type(date, holiday, summary=True),
        "last_digit": last_digit(F.dayofmonth(date)).cast("string"),
        "is_day_repdigit": day_repdigit(date),
        "is_month_day_match": month_day_match(date, summary=True),
        "is_anniversary": F.dayofmonth(date) == 20,
        "is_first_day": F.dayofmonth(date) == 1,
        "is_last_day": month_end(date),
    }


def with_holiday_flag(df: DataFrame, date: str, holidays: DataFrame | None) -> DataFrame:
    """Adds `is_holiday` by a left join with a table of holiday dates.

    The table is deduplicated; Catalyst broadcasts it when its measured size is
    below the broadcast threshold and shuffles otherwise.
    """
    if holidays is None:
        return df.withColumn("is_holiday", F.lit(False))
    days = holidays.select(F.col("holiday_date").alias("__h")).distinct()
    return (
        df.join(days, df[date] == F.col("__h"), "left")
        .withColumn("is_holiday", F.col("__h").isNotNull())
        .drop("__h")
    )


def special_day(profile: Column, date: Column) -> Column:
    """Special-day flag of a venue profile; an unknown profile has none."""
    out = None
    for name, rule in fixed.SPECIAL_PROFILES.items():
        flag = F.dayofmonth(date).isin(rule["days"]) if rule["days"] else F.lit(False)
        if rule["month_end"]:
            flag = flag | month_end(date)
        out = F.when(profile == name, flag) if out is None else out.when(profile == name, flag)
    return out.otherwise(False)


def day_category(date: Column, has_event: Column) -> Column:
    """Event, month end, listed last digit, normal - in this priority."""
    digit = last_digit(F.dayofmonth(date))
    out = F.when(has_event, fixed.CAT_EVENT).when(month_end(date), fixed.CAT_MONTH_END)
    for d in fixed.CAT_DIGITS:
        out = out.when(digit == d, fixed.digit_category(d))
    return out.otherwise(fixed.CAT_NORMAL)


def digit_features(date: Column, unit: Column) -> dict[str, Column]:
    return {
        "date_last_1digit": last_digit(F.dayofmonth(date)).cast("bigint"),
        "date_last_2digits": F.dayofmonth(date).cast("bigint"),
        "machine_last_1digit": F.pmod(unit, F.lit(10)).cast("bigint"),
        "machine_last_2digits": F.pmod(unit, F.lit(100)).cast("bigint"),
    }


def streak_label(n: int, rate: Column) -> Column:
    return F.when(rate == 1.0, fixed.wins(n)).when(rate == 0.0, fixed.losses(n))


def tier(category: Column, streaks: dict[int, Column]) -> tuple[Column, Column]:
    """(rank, text) of the first matching tier rule."""
    rank = text = None
    for cat, streak, value, label in fixed.TIER_RULES:
        hit = F.lit(True)
        if cat is not None:
            hit = hit & (category == cat)
        if streak is not None:
            hit = hit & F.coalesce(streaks[int(streak[0])] == streak, F.lit(False))
        if label.startswith("{category}"):
            words = F.concat(category, F.lit(label[len("{category}") :]))
        else:
            words = F.lit(label)
        rank = F.when(hit, value) if rank is None else rank.when(hit, value)
        text = F.when(hit, words) if text is None else text.when(hit, words)
    return rank.otherwise(fixed.TIER_DEFAULT[0]), text.otherwise(fixed.TIER_DEFAULT[1])
