import datetime as dt
import random

from pyspark.sql import functions as F

from floorlens.operators.dedupe import dedupe_collapse, dedupe_latest, duplicate_report
from floorlens.operators.remap import ShiftRule, remap_units
from floorlens.plans.mart import build_mart, clean_observations, unit_windows
from floorlens.sources import schemas
from floorlens.sources.local import local_table

D = dt.date
OBS = "date date, hole string, machine string, machine_number bigint, diff bigint, game bigint, win bigint"


def obs_rows(seed=1, days=80, units=3):
    """Gaps, NULLs, zero games and model changes that go back again."""
    r = random.Random(seed)
    out = []
    for u in range(units):
        for i in range(days):
            if r.random() < 0.35:
                continue
            model = "A" if (i // 17) % 2 == 0 or u == 0 else "B"
            diff = r.choice([None, 0, 100, -250, 777, -31])
            game = r.choice([None, 0, 900, 1500])
            win = None if diff is None else int(diff > 0)
            out.append((D(2024, 1, 20) + dt.timedelta(days=i), "V1", model, 100 + u, diff, game, win))
    return out


def literal(rows, t, prefix):
    """A window by its definition: rows of the unit and model within the dates."""
    day, hole, model, unit = t[:4]
    prev = prefix.startswith("prev_")
    base = prefix.removeprefix("prev_")
    end = day - dt.timedelta(days=1) if prev else day
    if base == "mtd":
        start = day.replace(day=1)
    elif base == "all":
        start = day - dt.timedelta(days=31)
    else:
        n = int(base[1:])
        start = day - dt.timedelta(days=n if prev else n - 1)
    hit = [x for x in rows if x[1:4] == (hole, model, unit) and start <= x[0] <= end]

    def total(i):
        vals = [x[i] for x in hit if x[i] is not None]
        return sum(vals) if vals else None

    diff, game, wins = total(4), total(5), total(6)
    pay = None if diff is None or not game else (game * 3 + diff) / (game * 3)
    rate = None if wins is None else wins / len(hit)
    return {"diff": diff, "game": game, "win_rate": rate, "payout_rate": pay, "days": len(hit) or None}


def test_window_pass_equals_literal_windows(spark):
    rows = obs_rows()
    got = build_mart(spark.createDataFrame([(*r, 1) for r in rows], OBS + ", ts bigint"), ts="ts").collect()
    assert len(got) == len(rows)
    by_key = {(r["target_date"], r["machine_number"]): r for r in got}
    for t in rows:
        row = by_key[(t[0], t[3])]
        for p in schemas.WINDOW_PREFIXES + ["prev_" + x for x in schemas.WINDOW_PREFIXES]:
            want = literal(rows, t, p)
            for name, _ in schemas.window_columns(p):
                assert row[name] == want[name.removeprefix(p + "_")], (t, name)
        starts = [x[0] for x in rows if x[1:4] == t[1:4] and t[0] - dt.timedelta(days=31) <= x[0] <= t[0]]
        assert row["start_date"] == min(starts)


def test_target_range_equals_full_build(spark):
    df = spark.createDataFrame([(*r, 1) for r in obs_rows(3)], OBS + ", ts bigint")
    a, b = D(2024, 3, 1), D(2024, 3, 10)
    part = build_mart(df, a, b, ts="ts")
    full = build_mart(df, ts="ts").where(f"target_date between date'{a}' and date'{b}'")
    assert part.count() == full.count() > 0
    assert part.exceptAll(full).count() == 0


def test_schema_has_102_columns(spark):
    assert len(schemas.MART.fields) == 102
    df = build_mart(spark.createDataFrame([], OBS + ", ts bigint"), ts="ts")
    assert df.columns == schemas.MART.fieldNames() and df.count() == 0


def test_calendar_columns_of_the_mart(spark):
    days = [D(2024, 2, 2), D(2024, 2, 11), D(2024, 2, 12), D(2024, 2, 29)]
    df = spark.createDataFrame([(d, "V", "A", 1, 1, 1, 1, 1) for d in days], OBS + ", ts bigint")
    hol = local_table(spark, [(D(2024, 2, 11),), (D(2024, 2, 12),)], schemas.HOLIDAY)
    got = {r.target_date: r for r in build_mart(df, holidays=hol, ts="ts").collect()}
    assert got[days[0]].is_month_day_repdigit and not got[days[0]].is_day_repdigit
    assert got[days[1]].day_type == "週末" and got[days[1]].is_day_repdigit  # a Sunday that is a holiday
    assert got[days[2]].day_type == "祝日" and got[days[2]].day_of_week_jp == "月"
    assert got[days[3]].day_type == "平日" and got[days[3]].target_day_last_digit == 9


def test_dedupe_newest_and_collapse(spark):
    rows = [("a", 1, 10), ("a", 3, 30), ("a", 3, 31), ("b", 2, 20)]
    df = spark.createDataFrame(rows, "id string, ts bigint, v bigint")
    assert {tuple(r) for r in dedupe_latest(df, ["id"], "ts", ["v"]).collect()} == {("a", 3, 31), ("b", 2, 20)}
    assert {tuple(r) for r in dedupe_collapse(df, ts="ts").collect()} == {("a", 1, 10), ("b", 2, 20)}
    again = dedupe_latest(dedupe_latest(df, ["id"], "ts", ["v"]), ["id"], "ts", ["v"])
    assert again.count() == 2
    assert duplicate_report(df, []).first().asDict() == {
        "total": 4, "unique_count": 2, "duplicate_count": 2, "has_duplicates": True,
    }


def test_remap_boundaries(spark):
    rows = [("A", D(2025, 11, 2), 5), ("A", D(2025, 11, 3), 5), ("A", D(2025, 11, 2), 6)]
    rows += [("B", D(2025, 4, 20), n) for n in (2019, 2020, 2999, 3000)] + [("B", D(2025, 4, 21), 2020)]
    df = spark.createDataFrame(rows, "hole string, date date, machine_number bigint")
    m = local_table(spark, [("A", D(2025, 11, 2), 5, 500)], schemas.REMAP)
    got = remap_units(df, m, [ShiftRule("B", D(2025, 4, 20), 2020, 3000, 2)]).collect()
    assert sorted(r.machine_number for r in got) == sorted([500, 5, 6, 2019, 2022, 3001, 3000, 2020])


def test_two_old_units_on_one_number_keep_one_row(spark):
    rows = [(D(2024, 1, 1), "A", "M", 1, 5, 1, 1, 1), (D(2024, 1, 1), "A", "M", 2, 6, 1, 1, 2)]
    df = spark.createDataFrame(rows, OBS + ", ts bigint")
    m = local_table(spark, [("A", D(2024, 1, 1), 1, 2)], schemas.REMAP)
    got = clean_observations(df, m, ts="ts").collect()
    assert [(r.machine_number, r.diff) for r in got] == [(2, 6)]


def test_plan_prunes_duplicates_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame([(*r, 1, "x") for r in obs_rows()], OBS + ", ts bigint, extra string").write.parquet(str(tmp_path / "o"))
    df = spark.read.parquet(str(tmp_path / "o"))
    plan = unit_windows(clean_observations(df, ts="ts"))._jdf.queryExecution().executedPlan().toString()
    partial, shuffle = plan.index("Partial"), plan.index("Exchange hashpartitioning(date")
    assert shuffle < partial  # printed top-down: the partial limit runs below the exchange
    assert plan.count("Exchange") == 2
    assert "extra" not in plan


def test_tasks_grow_with_the_rows(spark):
    """The window exchange has as many tasks as the rows ask for; few rows leave it to Spark."""
    from floorlens.session import TASK_ROWS, dealt

    df = spark.range(20).withColumn("k", F.col("id") % 5)
    assert dealt(df, ["k"], 20) is df and dealt(df, ["k"], None) is df
    many = dealt(df, ["k"], 9 * TASK_ROWS)
    assert many.rdd.getNumPartitions() == 10
    assert many.select("k", F.spark_partition_id().alias("p")).distinct().count() == 5
    obs = spark.createDataFrame(obs_rows(), OBS)
    want = sorted(map(str, unit_windows(obs).collect()))
    plan = unit_windows(obs, rows=9 * TASK_ROWS)
    assert "REPARTITION_BY_NUM" in plan._jdf.queryExecution().executedPlan().toString() and sorted(map(str, plan.collect())) == want
