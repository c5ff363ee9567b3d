"""Reports over back-test summaries: method matrix, best methods, comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed

KEYS = ["target_hole", "target_machine", "evaluation_days", "special_day_type"]
MATRIX_RULES = ["TOP1"] + [f"THRESHOLD_{p}PCT" for p in (95, 96, 97, 98, 99)]
MATRIX_VALUES = ["win_rate", "payout_rate", "avg_machines_per_day"]


def load_summary(df: DataFrame) -> DataFrame:
    """Numeric columns of an exported summary; text that is no number becomes NULL."""
    numeric = ["win_rate", "payout_rate", "avg_diff", "avg_machines_per_day"]
    return df.withColumns({c: F.col(c).try_cast("double") for c in numeric if c in df.columns})


def method_matrix(summary: DataFrame) -> DataFrame:
    """One row per study and method, one column group per selection rule.

    The rules are given, so the pivot needs no extra pass to find them.  A
    method without a TOP1 row is left out.
    """
    return (
        summary.groupBy(*KEYS, "score_method")
        .pivot("result_key", MATRIX_RULES)
        .agg(*[F.max(c).alias(c) for c in MATRIX_VALUES])
        .where(F.col("TOP1_payout_rate").isNotNull() | F.col("TOP1_win_rate").isNotNull())
    )


def _best(summary: DataFrame, rule: str, low: float, high: float, name: str) -> DataFrame:
    units = F.col("avg_machines_per_day")
    rows = summary.where((F.col("result_key") == rule) & units.between(low, high) & (F.col("payout_rate") > -1))
    w = Window.partitionBy(*KEYS).orderBy(F.col("payout_rate").desc(), "score_method")
    return (
        rows.withColumn("rn", F.row_number().over(w))
        .where("rn = 1")
        .select(
            *KEYS,
            F.col("score_method").alias(f"{name}_method"),
            F.col("payout_rate").alias(f"{name}_payout"),
            units.alias(f"{name}_units"),
        )
    )


def best_method(summary: DataFrame) -> DataFrame:
    """Best payout by TOP1, by the 98 % cut (1 to 2 units a day) and the 99 % cut (1 to 1.5)."""
    top1 = _best(summary, "TOP1", 0, float("inf"), "top1").drop("top1_units")
    th98 = _best(summary, "THRESHOLD_98PCT", 1.0, 2.0, "th98")
    th99 = _best(summary, "THRESHOLD_99PCT", 1.0, 1.5, "th99")
    gap = F.col("top1_payout") - F.col("th98_payout")
    return (
        top1.join(th98, KEYS, "left")
        .join(th99, KEYS, "left")
        .withColumns({"top1_th98_gap": F.round(gap, 2), "gap_below_one": F.abs(gap) < 1})
    )


def period_compare(summary: DataFrame, short: int = 60, long: int = 120) -> DataFrame:
    """TOP1 and 99 % payouts of two evaluation periods; zero counts as missing."""
    keys = ["target_hole", "target_machine", "special_day_type", "score_method"]

    def side(days, name):
        def value(rule):
            return F.max(F.when(F.col("result_key") == rule, F.nullif("payout_rate", F.lit(0.0))))

        return (
            summary.where(F.col("evaluation_days") == days)
            .groupBy(*keys)
            .agg(
                value("TOP1").alias(f"{name}_top1"),
                value("THRESHOLD_99PCT").alias(f"{name}_th99"),
                F.count_if(F.col("result_key") == "TOP1").alias("__n"),
            )
            .where("__n > 0")
            .drop("__n")
        )

    both = side(short, "short").join(side(long, "long"), keys, "full")
    return both.withColumns(
        {
            "top1_change": F.round(F.col("long_top1") - F.col("short_top1"), 2),
            "th99_change": F.round(F.col("long_th99") - F.col("short_th99"), 2),
        }
    )


def reliability_grade(summary: DataFrame) -> DataFrame:
    """Stars of the TOP1 result."""
    stars = label = None
    for win, pay, n, name in fixed.GRADES:
        hit = (F.col("win_rate") > win) & (F.col("payout_rate") > pay)
        stars = F.when(hit, n) if stars is None else stars.when(hit, n)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return summary.where("result_key = 'TOP1'").select(
        *KEYS,
        "score_method",
        "win_rate",
        "payout_rate",
        stars.otherwise(fixed.GRADE_LOWEST[0]).alias("stars"),
        label.otherwise(fixed.GRADE_LOWEST[1]).alias("grade"),
    )


def recent_trend(summary: DataFrame, periods=(14, 28, 60)) -> DataFrame:
    """Methods whose TOP1 payout is higher the shorter the period."""
    keys = ["target_hole", "target_machine", "special_day_type", "score_method"]
    wide = (
        summary.where("result_key = 'TOP1'")
        .groupBy(*keys)
        .pivot("evaluation_days", list(periods))
        .agg(F.max("payout_rate"))
    )
    names = [str(p) for p in periods]
    rising = F.lit(True)
    for a, b in zip(names, names[1:]):
        rising = rising & (F.col(a) > F.col(b))
    return wide.withColumn("rising", F.coalesce(rising, F.lit(False)))
