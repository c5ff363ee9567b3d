"""National holidays by rule: fixed days, moved Mondays, equinoxes, substitute and bridge days.

The rules hold from 1949 to 2099.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import calendar as cal

# The holiday law and its changes.
#: (name, month, day, first year, last year)
FIXED_DAYS = [
    ("元日", 1, 1, 1949, 2099),
    ("成人の日", 1, 15, 1949, 1999),
    ("建国記念の日", 2, 11, 1967, 2099),
    ("天皇誕生日", 2, 23, 2020, 2099),
    ("天皇誕生日", 4, 29, 1949, 1988),
    ("みどりの日", 4, 29, 1989, 2006),
    ("昭和の日", 4, 29, 2007, 2099),
    ("憲法記念日", 5, 3, 1949, 2099),
    ("みどりの日", 5, 4, 2007, 2099),
    ("こどもの日", 5, 5, 1949, 2099),
    ("海の日", 7, 20, 1996, 2002),
    ("敬老の日", 9, 15, 1966, 2002),
    ("体育の日", 10, 10, 1966, 1999),
    ("文化の日", 11, 3, 1948, 2099),
    ("勤労感謝の日", 11, 23, 1948, 2099),
    ("天皇誕生日", 12, 23, 1989, 2018),
    ("山の日", 8, 11, 2016, 2019),
    ("山の日", 8, 11, 2022, 2099),
]
#: (name, month, which Monday of it, first year, last year)
MONDAYS = [
    ("成人の日", 1, 2, 2000, 2099),
    ("海の日", 7, 3, 2003, 2019),
    ("海の日", 7, 3, 2022, 2099),
    ("敬老の日", 9, 3, 2003, 2099),
    ("体育の日", 10, 2, 2000, 2019),
    ("スポーツの日", 10, 2, 2022, 2099),
]
#: Days of one year only.
SINGLE_DAYS = [
    ("皇太子明仁親王の結婚の儀", "1959-04-10"),
    ("昭和天皇の大喪の礼", "1989-02-24"),
    ("即位礼正殿の儀", "1990-11-12"),
    ("皇太子徳仁親王の結婚の儀", "1993-06-09"),
    ("天皇の即位の日", "2019-05-01"),
    ("即位礼正殿の儀", "2019-10-22"),
    ("海の日", "2020-07-23"),
    ("スポーツの日", "2020-07-24"),
    ("山の日", "2020-08-10"),
    ("海の日", "2021-07-22"),
    ("スポーツの日", "2021-07-23"),
    ("山の日", "2021-08-08"),
]
#: Day of the month of an equinox in 1980 as a fraction, until 1979 and from 1980, and the yearly shift.
SPRING, AUTUMN, YEARLY = (20.8357, 20.8431), (23.2588, 23.2488), 0.242194
SUBSTITUTE, BRIDGE = "振替休日", "国民の休日"
SUBSTITUTE_FROM, BRIDGE_FROM, SUBSTITUTE_MOVES_FROM = dt.date(1973, 4, 12), dt.date(1985, 12, 27), dt.date(2007, 1, 1)


def equinox_day(year: Column, offsets: tuple[float, float]) -> Column:
    """Day of the month of an equinox (March or September)."""
    since = year - 1980
    early = (offsets[0] + YEARLY * since).cast("double") - ((year - 1983) / 4).cast("int")
    late = F.floor(offsets[1] + YEARLY * since) - F.floor(since / 4)
    return F.when(year < 1980, F.floor(early)).otherwise(late)


def statutory_name(date: Column) -> Column:
    """Name of the holiday that the law gives to a date itself, else null."""
    year, month, day = F.year(date), F.month(date), F.dayofmonth(date)
    key = month * 100 + day
    out = F.when(year < 1948, F.lit(None).cast("string"))
    for name, m, d, first, last in FIXED_DAYS:
        out = out.when((key == m * 100 + d) & year.between(first, last), name)
    which = F.when(F.dayofweek(date) == 2, F.floor((day + 6) / 7))
    for name, m, n, first, last in MONDAYS:
        out = out.when((month == m) & (which == n) & year.between(first, last), name)
    for name, when in SINGLE_DAYS:
        out = out.when(date == F.lit(dt.date.fromisoformat(when)), name)
    out = out.when((month == 3) & (day == equinox_day(year, SPRING)) & (year >= 1949), "春分の日")
    return out.when((month == 9) & (day == equinox_day(year, AUTUMN)), "秋分の日")


def holidays(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Rows (holiday_date, holiday_name) of the holidays from start to end, both included.

    A holiday on a Sunday gives the next day off, since 2007 the next day that is no holiday
    (three holidays in a row are the most there are). A day between two holidays is one, unless it is
    a Sunday or, as a Monday after a holiday, a substitute already.

    Each holiday of the law tells the day before and the three days after of itself; what a
    day is told decides it. The name of the law is worked out once a day.
    """
    days = cal.calendar(spark, start - dt.timedelta(days=3), end + dt.timedelta(days=1), "day")
    own = days.select("day", F.array_compact(F.array(statutory_name(F.col("day")))).alias("own"))
    told = own.select("day", F.explode("own").alias("own")).select("day", "own", F.explode(F.array(*map(F.lit, (-1, 0, 1, 2, 3)))).alias("off"))
    heard = told.groupBy(F.date_add("day", F.col("off")).alias("holiday_date")).agg(
        F.max(F.when(F.col("off") == 0, F.col("own"))).alias("own"), F.collect_set("off").alias("offs")
    )
    date, weekday = F.col("holiday_date"), F.dayofweek("holiday_date")

    def has(*offs: int) -> Column:
        return F.size(F.array_intersect("offs", F.array(*map(F.lit, offs)))) == len(offs)

    # the Sunday lies k days back, and all days since are holidays
    moved = (weekday == 2) & has(1)
    for k in (2, 3):
        moved = moved | ((weekday == k + 1) & has(*range(1, k + 1)) & (date >= F.lit(SUBSTITUTE_MOVES_FROM)))
    name = (
        F.when(F.col("own").isNotNull(), F.col("own"))
        .when(moved & (date >= F.lit(SUBSTITUTE_FROM)), SUBSTITUTE)
        .when(has(1, -1) & (weekday != 1) & (date >= F.lit(BRIDGE_FROM)), BRIDGE)
    )
    out = heard.select("holiday_date", name.alias("holiday_name"))
    return out.where(F.col("holiday_name").isNotNull() & date.between(F.lit(start), F.lit(end)))
