"""Registered queries: name -> function(spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorlens.functions import calendar as cal
from floorlens.operators import dedupe, remap
from floorlens.plans import backtest as bt
from floorlens.plans import effects, report, summary
from floorlens.plans import mart as mart_plan
from floorlens.plans import strategy as st
from floorlens.session import stored
from floorlens.sources import derived as d
from floorlens.sources import schemas

from . import oracle

OBS_ORDER = dict(ts="ts", ties=d.TIES)
RECO_METHODS = [
    "original",
    "simple",
    "rms_reliability",
    "rms_frequency",
    "rms_frequency_filter",
    "rms_frequency_anomaly",
    "rms_frequency_dual",
    "strategy_filter",
]


def rounded(df: DataFrame, digits: int = 6, exact=()) -> DataFrame:
    """Doubles to a fixed number of digits, for comparison between engines.

    Ratios of integers (`exact`) are the same everywhere and stay as they are;
    scores are already rounded by the plans that rank them.
    """
    exact = {*exact, "total_score", "top1_score", "top1_ratio", "outlier_threshold"}
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double" and c not in exact})


def common(spark):
    return dict(holidays=d.holidays(spark), mapping=d.unit_map(spark), shifts=d.SHIFTS, **OBS_ORDER)


def mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart_plan.build_mart(d.observations(spark, sf), **common(spark))


def unit_days(spark: SparkSession, sf: str) -> DataFrame:
    return mart_plan.clean_observations(d.observations(spark, sf), d.unit_map(spark), d.SHIFTS, **OBS_ORDER)


def _mart_part(prefixes, head):
    def run(spark, sf):
        cols = [n for p in prefixes for n, _ in schemas.window_columns(p)]
        return mart(spark, sf).select(*head, *cols)

    return run


def _calendar(make, extra=()):
    def run(spark, sf):
        days = cal.with_holiday_flag(unit_days(spark, sf), "date", d.holidays(spark))
        cols = make(F.col("date"), F.col("is_holiday"))
        return days.select("date", "hole", "machine_number", *[c.alias(n) for n, c in cols.items()])

    return run


def special_days(spark, sf):
    days = unit_days(spark, sf)
    profile = F.when(F.col("hole") == "H0", "island").otherwise("espas")
    return (
        days.withColumn("is_special_day", cal.special_day(profile, F.col("date")))
        .groupBy("date", "hole", "is_special_day")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def studies(mart_table, column, values):
    """Every venue and model of the data with its special-day profile, for each of `values`: a written table."""
    profile = F.when(F.col("hole") == "H0", "island").otherwise("espas")
    pairs = mart_table.select("hole", "machine").distinct().withColumn("special_day_type", profile)
    return stored(pairs.withColumn(column, F.explode(F.array(*map(F.lit, values)))))


def reco_params(mart_table):
    return studies(mart_table, "score_method", RECO_METHODS)


def scoring_mart(spark, sf):
    """The mart columns of the scoring plans as a written table.

    These plans read the mart several times, as they would read the stored one.
    """
    cols = ["target_date", "hole", "machine", "machine_number", "d1_diff", "d1_game"]
    return stored(mart(spark, sf).select(*cols, *st.RATES, *[f"prev_{c}" for c in st.RATES]))


def recommendation(spark, sf, **kw):
    table = scoring_mart(spark, sf)
    return st.recommend(table, reco_params(table), **kw)


def backtest_params(mart_table):
    return studies(mart_table, "evaluation_days", oracle.BACKTEST_PERIODS)


AS_OF = dt.date.fromisoformat(oracle.BACKTEST_AS_OF)


def backtest_rows(spark, sf):
    table = scoring_mart(spark, sf)
    return stored(bt.evaluation_rows(table, backtest_params(table)))


def backtest_picks(spark, sf):
    return bt.score_picks(bt.unit_scores(backtest_rows(spark, sf)))


def backtest_summary(spark, sf, candidates=None):
    table = scoring_mart(spark, sf)
    return bt.backtest(table, backtest_params(table), AS_OF, candidates=candidates)


def score_stats(spark, sf):
    """Spread of the scores of each floor, method and day."""
    return bt.score_stats(bt.unit_scores(backtest_rows(spark, sf)))


def _ranked(**kw):
    def run(spark, sf):
        ranked = recommendation(spark, sf, **kw).ranked
        cols = [*st.STUDY, "score_method", "target_date", "machine_number", "priority_rank"]
        return rounded(ranked.select(*cols, "total_score", "top1_ratio", "rank", "match_count"))

    return run


def _core() -> dict:
    incl = [p for p in schemas.WINDOW_PREFIXES if p not in ("mtd", "all")]
    excl = ["prev_" + p for p in incl]
    key = ["target_date", "hole", "machine_number", "machine", "start_date"]
    every = schemas.WINDOW_PREFIXES + ["prev_" + p for p in schemas.WINDOW_PREFIXES]
    head = [f.name for f in schemas.MART.fields][:14]
    obs = d.observations
    latest = ["machine", "diff", "game", "win", "ts"]
    q = {
        "dedupe_latest": lambda s, f: dedupe.dedupe_latest(obs(s, f), ["date", "hole", "machine_number"], **OBS_ORDER).select(
            "date", "hole", "machine_number", *latest
        ),
        "dedupe_latest_by_id": lambda s, f: dedupe.dedupe_latest(obs(s, f), ["id"], **OBS_ORDER).select("id", *latest),
        "dedupe_collapse": lambda s, f: dedupe.dedupe_collapse(obs(s, f), **OBS_ORDER).select("id", *latest),
        "dedupe_first": lambda s, f: dedupe.dedupe_first(
            obs(s, f), ["date", "hole", "machine_number", "source"], "ts", d.TIES
        ).select("date", "hole", "machine_number", "source", "diff", "ts"),
        "duplicate_report": lambda s, f: dedupe.duplicate_report(obs(s, f), ["date", "hole"]),
        "remap_units": lambda s, f: remap.remap_units(obs(s, f), d.unit_map(s), d.SHIFTS)
        .groupBy("date", "hole", "machine_number")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("diff").alias("diff")),
        "calendar_cols": _calendar(cal.mart_calendar),
        "calendar_summary_flags": _calendar(cal.summary_calendar),
        "digit_features": lambda s, f: unit_days(s, f).select(
            "date", "hole", "machine_number",
            *[c.alias(n) for n, c in cal.digit_features(F.col("date"), F.col("machine_number")).items()],
        ),
        "special_days": special_days,
        "mart_incl": _mart_part(incl, key),
        "mart_excl": _mart_part(excl, key),
        "mart_mtd_all": _mart_part(["mtd", "all", "prev_mtd", "prev_all"], key),
        "mart_full": _mart_part(every, head),
        "unit_stats_latest": lambda s, f: summary.latest_unit_statistics(obs(s, f), **common(s)),
        "heatmap_all": lambda s, f: summary.heatmap(obs(s, f), **common(s)),
        "heatmap_special": lambda s, f: summary.heatmap(
            obs(s, f), special=summary.SpecialFilter(True, "土日", "祝日", "06", True, None), **common(s)
        ),
        "condition_summary": lambda s, f: summary.condition_summary(obs(s, f), holidays=d.holidays(s), **OBS_ORDER),
        "study_baseline": lambda s, f: rounded(effects.baseline(mart(s, f))),
        "day_category_effect": lambda s, f: effects.day_category_effect(mart(s, f), d.event_days(s, f)),
        "day_category_effect_fanout": lambda s, f: effects.day_category_effect(
            mart(s, f), d.event_rows(s, f), collapse_events=False
        ),
        "streak_effect": lambda s, f: effects.streak_effect(mart(s, f)),
        "combined_effect": lambda s, f: effects.combined_effect(mart(s, f), d.event_days(s, f)),
        "tier_recommend": lambda s, f: effects.tier_recommendation(mart(s, f), d.event_days(s, f)),
        "tier_recommend_current": lambda s, f: effects.tier_recommendation(
            mart(s, f), d.event_days(s, f), current_streak=True
        ),
        "strategy_match": lambda s, f: recommendation(s, f)
        .matches.groupBy(*st.STUDY, "strategy")
        .agg(F.count(F.lit(1)).alias("matched_units")),
        "strategy_record": lambda s, f: rounded(recommendation(s, f).record, exact=["rec_win_rate"]),
        "strategy_scores": lambda s, f: rounded(
            recommendation(s, f).scores.select(
                *st.STUDY, "score_method", F.col("next_date").alias("target_date"), "machine_number", "match_count",
                "weighted_payout_rate", "weighted_win_rate", "rms", "frequency_bonus", "reliability_score",
                "anomaly_bonus", "dual_high_bonus", "total_score",
            )
        ),
        "strategy_recommend": _ranked(),
        "strategy_recommend_prev": _ranked(features="prev"),
        "strategy_recommend_literal": _ranked(features="prev", literal_precedence=True),
        "strategy_recommend_repeats": _ranked(dedupe_strategies=False),
        "backtest_record": lambda s, f: rounded(_backtest_record(s, f), exact=["rec_win_rate"]),
        "backtest_picks": lambda s, f: rounded(
            backtest_picks(s, f).select("*", "actual.*").drop("actual").withColumnsRenamed(
                {"diff": "actual_diff", "game": "actual_game"}
            )
        ),
        "backtest_summary": backtest_summary,
        "method_matrix": lambda s, f: report.method_matrix(backtest_summary(s, f)),
        "best_method": lambda s, f: report.best_method(backtest_summary(s, f)),
        "period_compare": lambda s, f: report.period_compare(backtest_summary(s, f), 60, 120),
        "reliability_grade": lambda s, f: report.reliability_grade(backtest_summary(s, f)),
        "backtest_summary_top10": lambda s, f: backtest_summary(s, f, 10),
        "recent_trend": lambda s, f: report.recent_trend(backtest_summary(s, f)).withColumnsRenamed(
            {"14": "payout_14", "28": "payout_28", "60": "payout_60"}
        ),
        "score_stats": score_stats,
    }
    return q


def _backtest_record(spark, sf):
    return bt.asked_record(backtest_rows(spark, sf))


@functools.cache
def queries() -> dict:
    from . import registry_more, registry_store, registry_studies

    return _core() | registry_more.queries() | registry_store.queries() | registry_studies.queries()
