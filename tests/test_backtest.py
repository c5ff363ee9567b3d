"""The back-test against a brute-force walk over days, rows and strategies."""

import collections
import datetime as dt
import math
import random
import statistics as stat

import pytest
from floorlens.functions import fixed
from floorlens.plans import backtest as bt
from floorlens.plans import strategy as st
from floorlens.session import stored

D = dt.date
RATES = st.RATES
COLS = ["target_date", "hole", "machine", "machine_number", "d1_diff", "d1_game"] + RATES + ["prev_" + c for c in RATES]


def mart_rows(seed=5, days=14, units=12):
    r = random.Random(seed)
    out = []
    for i in range(days):
        for u in range(units):
            if r.random() < 0.2:
                continue
            feats = []
            for _ in range(2):
                feats += [r.choice([None, 0.0, 0.2, 0.25, 0.4, 0.5, 0.75, 0.9, 1.0]) for _ in range(4)]
                feats += [r.choice([None, 0.9, 1.01, 1.03, 1.05]), r.choice([None, -5, 10, 10, 99, -400])]
            out.append((D(2024, 1, 24) + dt.timedelta(days=i), "V", "M", 100 + u, r.choice([None, 50, -50, 300]), r.choice([0, 100, 400]), *feats))
    return out


def special(d):
    return d.day in (6, 16, 26) or (d + dt.timedelta(days=1)).day == 1


def matches(row, prefix, best, worst, day):
    """Strategies of a row from the plain reading of the conditions."""
    def within(c, x):
        if x is None:
            return False
        lo = c.low is None or (x > c.low if c.low_open else x >= c.low)
        hi = c.high is None or (x <= c.high if c.high_closed else x < c.high)
        return lo and hi

    def value(c):
        return best if c.kind == "rank_best" else worst if c.kind == "rank_worst" else row[f"{prefix}d{c.period}_{c.kind}"]

    unit = row["machine_number"]
    day_hits = {
        "digit_match_1": unit % 10 == day.day % 10,
        "digit_match_2": unit % 100 == day.day,
        "digit_plus_1": unit % 10 == (day.day + 1) % 10,
        "digit_minus_1": unit % 10 == (day.day + 9) % 10,
        "special_day": special(day),
        "non_special_day": not special(day),
    }
    out = set()
    for a in st.long_conditions("backtest"):
        if a.kind != "none" and not within(a, value(a)):
            continue
        for b in st.short_win_conditions("backtest"):
            if b.kind == "none" or within(b, value(b)):
                out.add(a.sort * 100 + b.sort)
    return out | {c.sort for c in st.short_day_conditions() if day_hits[c.kind]}


def ranks(rows, col):
    best, worst = {}, {}
    for day in {r["target_date"] for r in rows}:
        same = [r for r in rows if r["target_date"] == day]
        down = sorted(same, key=lambda r: (r[col] is None, -(r[col] or 0), r["machine_number"]))
        up = sorted(same, key=lambda r: (r[col] is not None, r[col] or 0, r["machine_number"]))
        best |= {(day, r["machine_number"]): i + 1 for i, r in enumerate(down)}
        worst |= {(day, r["machine_number"]): i + 1 for i, r in enumerate(up)}
    return best, worst


def pct(x, k):
    if x is None:
        return None
    a, b, c = k
    if x >= c:
        return 1.0
    if x >= b:
        return 0.5 + 0.5 * (x - b) / (c - b)
    if x >= a:
        return 0.25 + 0.25 * (x - a) / (b - a)
    return max(0.0, 0.25 * x / a)


def brute(all_rows, candidates=None):
    rows = [dict(zip(COLS, r)) for r in all_rows]
    rows = [r for r in rows if r["d1_diff"] is not None]
    pb, pw = ranks(rows, "prev_d28_diff")
    cb, cw = ranks(rows, "d28_diff")
    for r in rows:
        k = (r["target_date"], r["machine_number"])
        r["past"] = matches(r, "prev_", pb[k], pw[k], r["target_date"])
        r["now"] = matches(r, "", cb[k], cw[k], r["target_date"] + dt.timedelta(days=1))
    by_key = {(r["target_date"], r["machine_number"]): r for r in rows}
    picks = {}
    for day in sorted({r["target_date"] for r in rows}):
        record = {}
        for s in {c for c, *_ in st.catalogue_rows("backtest")}:
            hit = [r for r in rows if r["target_date"] <= day and s in r["past"]]
            if not hit:
                continue
            win = sum(r["d1_diff"] > 0 for r in hit) / len(hit)
            pays = [(r["d1_game"] * 3 + r["d1_diff"]) / (r["d1_game"] * 3) for r in hit if r["d1_game"]]
            pay = sum(pays) / len(pays) if pays else None
            a, b = pct(win, fixed.WIN_KNOTS), pct(pay, fixed.PAYOUT_KNOTS)
            eff = None if b is None else (a + b) / 2
            record[s] = (len(hit), len({r["target_date"] for r in hit}), win, pay, eff)
        for method in fixed.SCORE_METHODS:
            sums = {}
            for r in (x for x in rows if x["target_date"] == day):
                m = w = p = v = dd = n = 0
                for s in r["now"]:
                    rec = record.get(s, (None, None, None, None, None))
                    eff = 1.0 if rec[4] is None else rec[4]
                    if method in fixed.FILTERED_METHODS and eff < 0.5:
                        continue
                    x = (rec[0] or 1) * eff
                    m, w, p, v = m + 1, w + x, p + x * (rec[3] or 0), v + x * (rec[2] or 0)
                    dd, n = dd + (rec[1] or 0), n + (rec[0] or 0)
                if m:
                    sums[r["machine_number"]] = (m, w, p, v, dd, n)
            if not sums:
                continue
            mm, mr = max(x[0] for x in sums.values()), max(x[4] + x[5] for x in sums.values())
            score = {}
            for unit, (m, w, p, v, dd, n) in sums.items():
                p, v = (p / w, v / w) if w > 0 else (0.0, 0.0)
                rms = math.sqrt((pct(v, fixed.WIN_KNOTS) ** 2 + pct(p, fixed.PAYOUT_KNOTS) ** 2) / 2)
                freq = min(math.sqrt(m) / math.sqrt(mm), 1.0)
                rel = min((dd + n) / mr, 1.0) if mr else 1.0
                steps = 1.0 if dd >= 30 and n >= 50 else 0.8 if dd >= 20 and n >= 30 else 0.6 if dd >= 10 and n >= 20 else 0.4
                odd = (1.1 if p > 1.0447 * 1.05 else 1.0) * (1.1 if v > 0.5 * 1.1 else 1.0)
                dual = 1.1 if p >= 1.0247 and v >= 0.429 else 1.0
                f = {"simple": rms, "rms_reliability": rms * steps, "rms_frequency": rms * freq, "rms_frequency_filter": rms * freq,
                     "rms_frequency_anomaly": rms * freq * odd, "rms_frequency_dual": rms * freq * dual}
                score[unit] = round(f.get(method, rms * rel * freq * odd * dual), 9)
            order = sorted(score, key=lambda u: (-score[u], u))
            vals = sorted(score.values())
            q = lambda x: vals[max(math.ceil(x * len(vals)), 1) - 1]
            sd = stat.stdev(vals) if len(vals) > 1 else 0.0
            cut = min(q(0.75) + (q(0.75) - q(0.25)), sum(vals) / len(vals) + 1.5 * sd)
            for rank, unit in enumerate(order[:candidates], 1):
                nxt = by_key.get((day + dt.timedelta(days=1), unit))
                picks[(method, day, unit)] = (score[unit], rank, round(cut, 6), nxt and nxt["d1_diff"])
    return picks


@pytest.mark.parametrize("candidates", [10, None])  # the ten of the published form, and the default without a cut
def test_picks_equal_the_brute_force_walk(spark, candidates):
    data = mart_rows()
    types = ["date", "string", "string", "bigint", "bigint", "bigint"] + (["double"] * 5 + ["bigint"]) * 2
    mart = spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in zip(COLS, types)))
    params = [bt.BacktestParam("V", "M", 100, "island")]
    rows = bt.evaluation_rows(mart, params)
    got = bt.score_picks(bt.unit_scores(rows), candidates).collect()
    want = brute(data, candidates)
    assert len(got) == len(want) > 500
    for r in got:
        score, rank, cut, diff = want[(r.score_method, r.target_date, r.machine_number)]
        assert abs(r.total_score - score) < 2e-9 and r["rank"] == rank, r
        assert abs(r.outlier_threshold - cut) < 2e-6
        assert (r.actual and r.actual["diff"]) == diff


def test_summary_rules_are_nested(spark):
    data = mart_rows(9)
    types = ["date", "string", "string", "bigint", "bigint", "bigint"] + (["double"] * 5 + ["bigint"]) * 2
    mart = spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in zip(COLS, types)))
    params = [bt.BacktestParam("V", "M", n, "island") for n in (5, 100)]
    got = bt.backtest(mart, params, D(2024, 2, 6)).collect()
    n = {(r.evaluation_days, r.score_method, r.result_key): r.total_machines for r in got}
    for method in fixed.SCORE_METHODS:
        for days in (5, 100):
            tops = [n[(days, method, f"TOP{k}")] for k in (1, 2, 3, 4, 5)]
            assert tops == sorted(tops)
            assert n[(days, method, "THRESHOLD_80PCT")] >= n[(days, method, "THRESHOLD_99PCT")] >= tops[0] * 0
        assert n[(100, method, "TOP1")] >= n[(5, method, "TOP1")]


def test_catalogue_counts():
    rows = st.catalogue_rows()
    assert len(rows) == 253 == len({r[1] for r in rows}) == len({r[0] for r in rows})
    repeats = sum(1 for r in rows if r[3] == 0)
    assert len(rows) + repeats == 266
    assert ("全条件なし" in {r[1] for r in rows}) and ("+特日" in {r[1] for r in rows})


def test_parameters_as_a_table_and_score_stats(spark):
    """A table of parameters gives what the list gives; score statistics equal a literal count."""
    data = mart_rows(9)
    types = ["date", "string", "string", "bigint", "bigint", "bigint"] + (["double"] * 5 + ["bigint"]) * 2
    mart = spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in zip(COLS, types)))
    params = [bt.BacktestParam("V", "M", n) for n in (5, 100)]
    table = spark.createDataFrame([("V", "M", 5), ("V", "M", 100), ("X", "M", 5)], "hole string, machine string, evaluation_days int")
    same = [sorted(map(str, bt.backtest(mart, p, D(2024, 2, 6)).collect())) for p in (params, table)]
    assert same[0] == same[1] and same[0]
    assert bt.backtest(mart, table.where("false"), D(2024, 2, 6)).count() == 0

    wanted = [st.RecoParam("V", "M", "island", m) for m in ("simple", "strategy_filter")]
    asked = spark.createDataFrame([(p.hole, p.machine, p.special_day_type, p.score_method) for p in wanted], "hole string, machine string, special_day_type string, score_method string")
    ranked = [sorted(map(str, st.recommend(mart, p).ranked.collect())) for p in (wanted, asked)]
    assert ranked[0] == ranked[1] and ranked[0]

    scores = bt.unit_scores(bt.evaluation_rows(mart, params))
    floors = {}
    for r in scores.collect():
        floors.setdefault((r.score_method, r.target_date), []).append(r.total_score)
    stats = bt.score_stats(scores).collect()
    assert len(stats) == len(floors)
    for r in stats:
        x = sorted(floors[(r.score_method, r.target_date)])
        nearest = [x[-(-len(x) * k // 4) - 1] for k in (1, 3)]
        assert (r.units, r.min_score, r.max_score, r.top1_score, r.q1_score, r.q3_score) == (len(x), x[0], x[-1], x[-1], *nearest)
        assert abs(r.avg_score - sum(x) / len(x)) < 1e-6 and abs(r.threshold_95 - 0.95 * x[-1]) < 2e-9


def test_no_exchange_carries_rows_times_strategies(spark):
    """Rows go to the task of their study once; whatever the strategies multiply stays there."""
    types = ["date", "string", "string", "bigint", "bigint", "bigint"] + (["double"] * 5 + ["bigint"]) * 2
    mart = spark.createDataFrame(mart_rows(), ", ".join(f"{c} {t}" for c, t in zip(COLS, types)))
    rows = stored(bt.evaluation_rows(mart, [bt.BacktestParam("V", "M", 100)]))
    recommended = st.recommend(mart, [st.RecoParam("V", "M")])
    for df in (bt.asked_record(rows), bt.unit_scores(rows, methods=["simple"]), recommended.record):
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        generated = [i for i, line in enumerate(plan) if "Generate " in line]
        assert generated
        above = [line for line in plan[: generated[-1]] if " Exchange " in line]
        assert not above, above


def test_outcome_totals_equal_a_loop(spark):
    """Totals and days of a strategy from rows with arrays of strategies; null days and repeated rows count."""
    r = random.Random(4)
    rows = [("A", None if i % 11 == 0 else D(2024, 1, 1 + i % 9), i % 4, r.choice([None, -50, 80, 200]), r.choice([0, 100, 300]), r.sample(range(6), r.randint(0, 4))) for i in range(70)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "k string, target_date date, machine_number long, diff long, game long, codes array<int>").repartition(1)
    want = {}
    for _, day, _, diff, game, codes in rows:
        for c in codes:
            t = want.setdefault(c, [0, 0, 0.0, 0, set()])
            t[0] += 1
            t[1] += diff is not None and diff > 0
            if diff is not None and game:
                t[2] += (game * 3 + diff) / (game * 3)
                t[3] += 1
            t[4].add(day)
    got = {x["strategy"]: x for x in st.outcome_totals(df, ["k"], "codes", "diff", "game").collect()}
    assert got.keys() == want.keys()
    for c, (n, wins, pay, pays, days) in want.items():
        x = got[c]
        assert (x["n"], x["wins"] or 0, x["pays"], x["days"]) == (n, wins, pays, len(days)) and (x["pay"] or 0.0) == pytest.approx(pay)


def test_strategies_are_columns_and_a_walk_does_not_depend_on_batches(spark):
    """No row for a strategy, no window or grouping over strategies; days that batches cut in two, rows that come
    again and rows without a day, unit or profile give what one batch gives."""
    types = ["date", "string", "string", "bigint", "bigint", "bigint"] + (["double"] * 5 + ["bigint"]) * 2
    data = mart_rows(11, days=10)
    data += [(None if i % 3 else r[0], *r[1:3], None if i % 3 == 1 else r[3], *r[4:]) for i, r in enumerate(data[:9])]
    mart = spark.createDataFrame(data, ", ".join(f"{c} {t}" for c, t in zip(COLS, types)))
    params = spark.createDataFrame([("V", "M", 100, p) for p in ("island", "espas", None)], "hole string, machine string, evaluation_days int, special_day_type string")
    rows = stored(bt.evaluation_rows(mart, params))
    scores, record = bt.unit_scores(rows), bt.asked_record(rows)
    for df in (scores, record):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "array_union" not in plan and "Aggregate" not in plan and "strategy" not in "".join(x for x in plan.splitlines() if "Window" in x)
    whole = [collections.Counter(map(str, df.collect())) for df in (scores, record)]
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        pieces = [collections.Counter(map(str, df.select("*").collect())) for df in (scores.select("hole", "special_day_type", "target_date", "machine_number", "actual", "score_method", "total_score", "refs"), record.drop("rec_payout_rate", "effectiveness"))]
        assert whole[1] and not any(r.special_day_type is None or r.target_date is None for r in record.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    again = [scores.select("hole", "special_day_type", "target_date", "machine_number", "actual", "score_method", "total_score", "refs"), record.drop("rec_payout_rate", "effectiveness")]
    assert pieces == [collections.Counter(map(str, df.collect())) for df in again]


def test_summary_multiplies_sums_not_rows_by_rules(spark):
    """Rules multiply the sums of alike rows; days and units of each rule equal a literal count."""
    types = ["date", "string", "string", "bigint", "bigint", "bigint"] + (["double"] * 5 + ["bigint"]) * 2
    mart = spark.createDataFrame(mart_rows(3), ", ".join(f"{c} {t}" for c, t in zip(COLS, types)))
    params = [bt.BacktestParam("V", "M", n) for n in (4, 8, 100)]
    picks = bt.score_picks(bt.unit_scores(stored(bt.evaluation_rows(mart, params)))).localCheckpoint()
    summary = bt.backtest_summary(picks, params, D(2024, 2, 6))
    plan = summary._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert any("Aggregate" in line for line in plan[below:])
    want = {}
    for r in picks.collect():
        rules = {f"TOP{k}" for k in fixed.TOP_RULES if r["rank"] <= k} | {f"THRESHOLD_{p}PCT" for p in fixed.THRESHOLD_RULES if r.total_score >= r.top1_score * (p / 100)}
        rules |= {"OUTLIER"} if r.total_score >= r.outlier_threshold else set()
        for n in (4, 8, 100):
            if r.actual and r.target_date >= D(2024, 2, 6) - dt.timedelta(days=n):
                for rule in rules:
                    want.setdefault((n, r.score_method, rule), []).append((r.target_date, r.actual["diff"]))
    got = {(r.evaluation_days, r.score_method, r.result_key): r for r in summary.collect()}
    assert got.keys() == want.keys()
    for key, x in want.items():
        r, diffs = got[key], [d for _, d in x]
        assert (r.evaluation_days_count, r.total_machines, r.total_diff, r.max_diff, r.min_diff) == (len({d for d, _ in x}), len(x), sum(diffs), max(diffs), min(diffs))
