"""Pair and group studies against literal loops, components against a union-find, the forecast on planted effects."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from floorlens.operators.components import components
from floorlens.plans import forecast, pairs

DAY0 = dt.date(2024, 1, 1)
SCHEMA = "hole string, machine string, machine_number long, target_date date, d1_diff long, d1_payout_rate double, note string"


def floors():
    """Units that follow a common value of their pair, with gaps, null payouts and a constant unit."""
    r = random.Random(8)
    rows = []
    for hole in ("A", None):
        common = {(d, g): r.gauss(0, 1) for d in range(90) for g in range(7)}
        for unit in range(13):
            for d in range(90):
                if r.random() < 0.2 or (unit == 12 and d > 20):
                    continue
                v = 1 + 0.1 * (common[d, unit // 2] + r.gauss(0, 0.6))
                pay = None if r.random() < 0.05 else 1.0 if unit == 11 else v
                diff = None if r.random() < 0.03 else round((v - 1) * 1000)
                rows.append((hole, "M", 100 + unit, DAY0 + dt.timedelta(days=d), diff, pay, "x"))
    return rows


def corr(xs):
    if len(xs) < 2:
        return None
    try:
        return round(statistics.correlation([a for a, _ in xs], [b for _, b in xs]), 9)
    except statistics.StatisticsError:
        return None


@pytest.fixture(scope="module")
def mart(spark):
    return spark.createDataFrame(floors(), SCHEMA)


def by_unit(rows):
    out = {}
    for hole, machine, unit, day, diff, pay, _ in rows:
        out.setdefault((hole, machine, unit), {})[day] = (diff or 0, pay)
    return out


@pytest.mark.parametrize("block", [4, 64])
def test_same_day_partners_equal_a_loop(mart, block):
    units = by_unit(floors())
    want = {}
    for a, x in units.items():
        near = []
        for b, y in units.items():
            days = sorted(set(x) & set(y))
            if a != b and a[:2] == b[:2] and len(days) >= 30:
                r = corr([(x[d][1], y[d][1]) for d in days if x[d][1] is not None and y[d][1] is not None])
                near.append((r is None, -(r or 0), b[2], len(days), sum(x[d][0] > 0 and y[d][0] > 0 for d in days)))
        if near:
            none, minus, partner, n, wins = min(near)
            want[a] = (len(near), sum(not q[0] and -q[1] > 0.5 for q in near), partner, None if none else -minus, n, wins / n)
    got = {tuple(x)[:3]: tuple(x)[3:] for x in pairs.same_day_partners(mart, block=block).collect()}
    assert got.keys() == want.keys() and len(want) == 24
    for k, v in want.items():
        assert got[k][:3] == v[:3] and got[k][4:] == v[4:]
        assert got[k][3] == pytest.approx(v[3], abs=2e-9) if v[3] is not None else got[k][3] is None


@pytest.mark.parametrize("block", [4, 64])
def test_next_day_successors_equal_a_loop(mart, block):
    units = by_unit(floors())
    one = dt.timedelta(days=1)
    want = {}
    for a, x in units.items():
        near = []
        for b, y in units.items():
            steps = [(x[d][0], y[d + one][0]) for d in x if d + one in y]
            if a[:2] == b[:2] and len(steps) >= 30:
                lost, won = [q for p, q in steps if p < 0], [q for p, q in steps if p > 0]
                rate = round(sum(q > 0 for q in lost) / len(lost), 9) if lost else None
                near.append((rate is None, -(rate or 0), b[2], sum(q > 0 for q in won) / len(won), len(steps)))
        if near:
            best = min(near)
            want[a] = (len(near), best[2], -best[1], best[3], best[4])
    got = {tuple(x)[:3]: tuple(x)[3:] for x in pairs.next_day_successors(mart, block=block).collect()}
    assert got == want


def test_groups_follow_the_planted_pairs(mart):
    links = pairs.correlated_links(mart, block=4)
    groups = {tuple(x)[:3]: tuple(x)[3:] for x in pairs.correlated_groups(links).collect()}
    assert groups[("A", "M", 101)] == (100, 2) and groups[(None, "M", 105)] == (104, 2)
    days = pairs.group_days(mart, pairs.correlated_groups(links)).where("group_id = 100 and hole = 'A'").orderBy("target_date").collect()
    assert days[0]["group_momentum"] is None
    assert [x["group_momentum"] for x in days[1:]] == [x["avg_payout_rate"] for x in days[:-1]]


def test_studies_of_nothing(mart):
    empty = mart.limit(0)
    for study in (pairs.same_day_partners, pairs.next_day_successors, pairs.correlated_links):
        assert study(empty).collect() == []
    assert pairs.correlated_groups(pairs.correlated_links(empty)).collect() == []


def test_no_plan_has_pairs_as_rows(mart):
    plan = pairs.same_day_partners(mart)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_components_equal_a_union_find(spark):
    r = random.Random(3)
    links = [(k, a, a + 1) for k, n in ((None, 300), ("x", 40)) for a in range(n)]  # long chains
    links += [("y", 0, i) for i in range(1, 200)] + [("z", 5, 5), ("z", None, 1), ("z", 7, 6), ("z", 7, 6)]
    links += [("r", r.randrange(80), r.randrange(80)) for _ in range(60)]
    r.shuffle(links)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, a, b in links:
        if a is not None and b is not None:
            p, q = sorted((find((k, a)), find((k, b))), key=lambda x: x[1])
            parent[q] = p
    df = spark.createDataFrame(links, "kind string, a long, b long")
    got = {(x["kind"], x["node"]): x["label"] for x in components(df, ["kind"], "a", "b").collect()}
    assert got == {x: find(x)[1] for x in list(parent)}


def forecast_rows(spark):
    r = random.Random(5)
    rows = []
    for unit in range(30):
        for d in range(200):
            day = DAY0 + dt.timedelta(days=d)
            level = 1.3 if day.isoweekday() == 6 else 0.9
            rows.append(("A", "M", unit, day, level + r.gauss(0, 0.05) if r.random() > 0.02 else None, float(unit % 10)))
    df = spark.createDataFrame(rows, "hole string, machine string, machine_number long, target_date date, d1_payout_rate double, machine_last_digit double")
    known = {"weekday": F.dayofweek("target_date").cast("double"), "day_of_month": F.dayofmonth("target_date").cast("double")}
    return df.withColumns({c: known.get(c, F.lit(forecast.UNKNOWN)) for c in forecast.FEATURES if c != "machine_last_digit"})


def test_the_forecast_finds_a_planted_weekday(spark):
    rows = forecast_rows(spark).cache()
    validate_from, forecast_from = forecast.split_days(rows)
    assert DAY0 < validate_from < forecast_from
    model = forecast.fit(rows, validate_from, forecast_from, trees=15, depth=3)
    ahead = forecast.forecast(model, rows, forecast_from)
    assert ahead.count() == rows.where(F.col("target_date") >= F.lit(forecast_from)).count()
    error = forecast.errors(ahead, rows, forecast_from).first()
    assert error["forecast_error"] < 0.1 < error["own_mean_error"]
    weight = {x["feature"]: x["importance"] for x in forecast.importances(model).collect()}
    assert weight["weekday"] > 0.8 and math.isclose(sum(weight.values()), 1)
    ranks = ahead.groupBy("hole", "target_date").agg(F.max("place").alias("last"), F.count("*").alias("n"), F.min("prediction_rank").alias("first"))
    assert ranks.where("last <> n or first <> 0").count() == 0


def test_no_feature_sees_the_day_that_it_predicts(spark):
    from checks import registry, registry_more

    sf = "/root/testdata/sf0.001"
    table = registry.mart(spark, sf)
    last = table.agg(F.max("target_date")).first()[0]
    profile, days = registry_more._venue_profile(), registry_more._venue_days(spark, sf)
    changed = table.withColumns({c: F.when(F.col("target_date") == F.lit(last), F.lit(9)).otherwise(F.col(c)).cast(t) for c, t in table.dtypes if c in ("d1_diff", "d1_game", "d1_payout_rate")})
    seen = [forecast.model_rows(t, profile, days).where(F.col("target_date") == F.lit(last)).drop(forecast.LABEL).orderBy("hole", "machine", "machine_number").collect() for t in (table, changed)]
    assert seen[0] and seen[0] == seen[1]


def test_no_days_cannot_be_split(spark):
    with pytest.raises(ValueError):
        forecast.split_days(forecast_rows(spark).limit(0))
