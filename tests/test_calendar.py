import datetime as dt

from pyspark.sql import functions as F

from floorlens.functions import calendar as cal
from floorlens.functions import scalars as sc

D = dt.date


def test_month_day_match_of_a_leap_year(spark):
    days = cal.calendar(spark, D(2024, 1, 1), D(2024, 12, 31))
    got = [r[0] for r in days.where(cal.month_day_match(F.col("date"), True)).orderBy("date").collect()]
    want = [D(2024, m, m) for m in range(1, 13)] + [D(2024, 1, 11), D(2024, 2, 22)]
    assert got == sorted(want)
    ends = [r[0] for r in days.where(cal.month_end(F.col("date"))).orderBy("date").collect()]
    assert len(ends) == 12 and D(2024, 2, 29) in ends


def test_special_day_profiles(spark):
    days = cal.calendar(spark, D(2025, 2, 1), D(2025, 2, 28))
    def hits(p):
        return [r[0].day for r in days.where(cal.special_day(F.lit(p), F.col("date"))).orderBy("date").collect()]
    assert hits("island") == [6, 16, 26, 28]
    assert hits("espas") == [6, 14, 16, 26, 28]
    assert hits("none") == [] == hits("other")


def test_run_time_and_target_date(spark):
    ts = ["2026-01-09 14:59:59", "2026-01-09 15:00:00"]
    df = spark.createDataFrame([(t,) for t in ts], "t string").select(F.col("t").cast("timestamp").alias("t"))
    got = [r[0] for r in df.select(sc.target_date(F.col("t"))).collect()]
    assert got == [D(2026, 1, 8), D(2026, 1, 9)]
    back = spark.range(1).select(sc.run_time(F.lit(D(2026, 1, 9))).cast("string")).first()[0]
    assert back == "2026-01-09 15:00:00"


def test_relative_dates_in_either_order(spark):
    a = [r[0] for r in cal.relative_dates(spark, D(2024, 3, 1), 3, 1).collect()]
    b = [r[0] for r in cal.relative_dates(spark, D(2024, 3, 1), 1, 3).collect()]
    assert a == b == [D(2024, 2, 27), D(2024, 2, 28), D(2024, 2, 29)]


def test_category_priority_and_tier(spark):
    rows = [(D(2024, 1, 31), True), (D(2024, 1, 31), False), (D(2024, 1, 18), False), (D(2024, 1, 5), False), (D(2024, 1, 11), False)]
    df = spark.createDataFrame(rows, "d date, e boolean")
    got = [r[0] for r in df.select(cal.day_category(F.col("d"), F.col("e"))).collect()]
    assert got == ["LINE告知", "月末", "8のつく日", "通常日", "1のつく日"]
    streaks = {2: F.lit(None).cast("string"), 3: F.lit("3連敗"), 5: F.lit("5連勝")}
    def tier(c):
        return tuple(spark.range(1).select(*cal.tier(F.lit(c), streaks)).first())
    assert tier("8のつく日") == (5, "8のつく日+3連敗 (108.81%)")
    assert tier("通常日") == (4, "通常日+5連勝 (107.24%)")
    assert tier("0のつく日") == (0, "対象外（避けるべき日）")


def test_scores_and_null_rules(spark):
    xs = [None, -1.0, 0.0, 0.357, 0.393, 0.429, 0.5, 0.9]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(sc.pct_score(F.col("x"), (0.357, 0.429, 0.5))).collect()]
    assert got[0] is None and got[1] == 0.0 and got[2] == 0.0
    assert got[3] == 0.25 and abs(got[4] - 0.375) < 1e-12 and got[5] == 0.5 and got[6:] == [1.0, 1.0]


def test_clean_int_and_error_classes(spark):
    df = spark.createDataFrame([("+1,200",), ("-3",), ("12px",), ("--",), (None,), (" 7 ",)], "t string")
    assert [r[0] for r in df.select(sc.clean_int(F.col("t"))).collect()] == [1200, -3, 12, None, None, 7]
    msgs = [("x", "Just a moment..."), ("Navigation timeout", ""), ("net::ERR", ""), ("Cannot read x", ""), ("?", None)]
    m = spark.createDataFrame(msgs, "m string, t string")
    got = [r[0] for r in m.select(sc.classify_error(F.col("m"), F.col("t"))).collect()]
    assert got == ["cloudflare", "timeout", "network", "parse", "unknown"]


def test_floor_slug(spark):
    df = spark.createDataFrame([("1F",), (" B1 / 2 ",), ("階",), (None,)], "f string")
    assert [r[0] for r in df.select(sc.floor_slug(F.col("f"))).collect()] == ["1f", "b1-2", "1f", "1f"]
