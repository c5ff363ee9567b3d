"""Strategy catalogue, matching, track record, unit scores and recommendation.

A strategy is a long condition with a short condition, coded as
long * 100 + short.  A row finds its strategies by evaluating the 13 + 25
conditions once and combining those that hold, instead of testing every row
against every strategy of the catalogue.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, fields

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions import fixed
from ..functions.scalars import RANK_DIGITS, effectiveness, pct_score, payout, safe_div, win_flag
from ..session import stored
from ..sources.local import local_table
from .summary import latest_dates

_WIN, _PAY = fixed.WIN_KNOTS, fixed.PAYOUT_KNOTS


@dataclass(frozen=True)
class Condition:
    """low <= x < high by default; the flags open or close the ends."""

    sort: int
    name: str
    kind: str
    period: int = 0
    low: float | None = None
    high: float | None = None
    low_open: bool = False
    high_closed: bool = False

    def holds(self, x, hit=None):
        """Of a column or, from `hit` on, of an array."""
        hit = F.lit(True) if hit is None else hit
        if self.low is not None:
            hit = hit & ((x > self.low) if self.low_open else (x >= self.low))
        if self.high is not None:
            hit = hit & ((x <= self.high) if self.high_closed else (x < self.high))
        return hit


def long_conditions(version: str = "recommend") -> list[Condition]:
    """The back-test closes the win-rate bands at the upper end."""
    closed = version == "backtest"
    w25, w50, w75 = _WIN
    p25, p50, p75 = _PAY
    win, pay, diff = "過去28日間勝率", "過去28日間機械割", "過去28日間差枚"
    # names and sort numbers (fixed values)
    return [
        Condition(0, fixed.NO_CONDITION, "none"),
        Condition(1, f"{win}50.0%以上", "win_rate", 28, w75),
        Condition(2, f"{win}42.9%以上50.0%未満", "win_rate", 28, w50, w75, high_closed=closed),
        Condition(3, f"{win}35.7%以上42.9%未満", "win_rate", 28, w25, w50, high_closed=closed),
        Condition(4, f"{win}35.7%未満", "win_rate", 28, None, w25),
        Condition(7, f"{pay}104.47%以上", "payout_rate", 28, p75),
        Condition(8, f"{pay}102.47%以上104.47%未満", "payout_rate", 28, p50, p75),
        Condition(9, f"{pay}100.91%以上102.47%未満", "payout_rate", 28, p25, p50),
        Condition(10, f"{pay}100.91%未満", "payout_rate", 28, None, p25),
        Condition(11, f"{diff}ベスト1~5", "rank_best", 28, 1, 5, high_closed=True),
        Condition(12, f"{diff}ベスト6~10", "rank_best", 28, 6, 10, high_closed=True),
        Condition(13, f"{diff}ワースト1~5", "rank_worst", 28, 1, 5, high_closed=True),
        Condition(14, f"{diff}ワースト6~10", "rank_worst", 28, 6, 10, high_closed=True),
    ]


def short_win_conditions(version: str = "recommend") -> list[Condition]:
    """The back-test closes every band at the upper end, the recommendation only one."""
    closed = version == "backtest"
    out = [Condition(0, "", "none")]
    for i, n in enumerate((3, 5, 7)):
        p = f"+過去{n}日間勝率"
        k = i * 10
        # names and sort numbers (fixed values)
        out += [
            Condition(k + 1, f"{p}100%", "win_rate", n, 1.0, 1.0, high_closed=True),
            Condition(k + 2, f"{p}75%超100%未満", "win_rate", n, 0.75, 1.0, True, closed),
            Condition(k + 3, f"{p}50%超75%以下", "win_rate", n, 0.5, 0.75, True, True),
            Condition(k + 4, f"{p}25%超50%以下", "win_rate", n, 0.25, 0.5, True, closed),
            Condition(k + 5, f"{p}0%超25%未満", "win_rate", n, 0.0, 0.25, True, closed),
            Condition(k + 6, f"{p}0%", "win_rate", n, 0.0, 0.0, high_closed=True),
        ]
    return out


def short_day_conditions() -> list[Condition]:
    """Digit and special-day conditions; they combine only with the empty long one."""
    # names and sort numbers (fixed values)
    return [
        Condition(30, "+台番末尾1桁=日付末尾1桁", "digit_match_1"),
        Condition(31, "+台番末尾2桁=日付末尾2桁", "digit_match_2"),
        Condition(32, "+台番末尾1桁=日付末尾1桁+1", "digit_plus_1"),
        Condition(33, "+台番末尾1桁=日付末尾1桁-1", "digit_minus_1"),
        Condition(40, "+特日", "special_day"),
        Condition(41, "+特日以外", "non_special_day"),
    ]


def strategy_name(long: Condition, short: Condition) -> str:
    if long.kind == "none":
        return short.name or fixed.NO_CONDITION_AT_ALL
    return long.name + short.name


def catalogue_rows(version: str = "recommend") -> list[tuple[int, str, int, int]]:
    """(code, name, long, short) of the 253 distinct strategies.

    The published list repeats the empty short condition, which makes 266 rows;
    see `multiplicity`.
    """
    pairs = [(a, b) for a in long_conditions(version) for b in short_win_conditions(version)]
    pairs += [(long_conditions(version)[0], b) for b in short_day_conditions()]
    return [(a.sort * 100 + b.sort, strategy_name(a, b), a.sort, b.sort) for a, b in pairs]


def catalogue(spark: SparkSession, version: str = "recommend") -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("strategy", T.IntegerType()),
            T.StructField("strategy_name", T.StringType()),
            T.StructField("long_condition", T.IntegerType()),
            T.StructField("short_condition", T.IntegerType()),
        ]
    )
    return local_table(spark, catalogue_rows(version), schema)


def multiplicity(strategy: Column, dedupe_strategies: bool = True) -> Column:
    """How often the published list contains the strategy."""
    if dedupe_strategies:
        return F.lit(1)
    return F.when(F.pmod(strategy, F.lit(100)) == 0, F.lit(2)).otherwise(F.lit(1))


@dataclass(frozen=True)
class Features:
    """Where the inputs of the conditions are found."""

    prefix: str  # "prev_" or ""
    best: str
    worst: str
    day: Column  # the day whose digits and special flag count
    special: Column

    def value(self, c: Condition) -> Column:
        if c.kind == "rank_best":
            return F.col(self.best)
        if c.kind == "rank_worst":
            return F.col(self.worst)
        return F.col(f"{self.prefix}d{c.period}_{c.kind}")

    def day_hit(self, c: Condition) -> Column:
        unit1, unit2 = F.pmod("machine_number", F.lit(10)), F.pmod("machine_number", F.lit(100))
        dom = F.dayofmonth(self.day)
        return {
            "digit_match_1": unit1 == cal.last_digit(dom),
            "digit_match_2": unit2 == dom,
            "digit_plus_1": unit1 == cal.last_digit(dom + 1),
            "digit_minus_1": unit1 == cal.last_digit(dom + 9),
            "special_day": self.special,
            "non_special_day": ~self.special,
        }[c.kind]


def _holding(conditions: list[Condition], hit) -> Column:
    """Sort numbers of the conditions that hold."""
    found = [F.lit(c.sort) if c.kind == "none" else F.when(hit(c), F.lit(c.sort)) for c in conditions]
    return F.array_compact(F.array(*found))


def matched_strategies(f: Features, version: str, literal_precedence: bool = False) -> Column:
    """Codes of the strategies a row matches.

    literal_precedence follows the published text of the recommendation, in
    which OR and AND mix without brackets: a strategy then matches by its long
    or by its short condition, and only the last long condition is tied to the
    empty short one.
    """
    longs, wins, days = long_conditions(version), short_win_conditions(version), short_day_conditions()
    long_hits = _holding(longs, lambda c: c.holds(f.value(c)))
    win_hits = _holding(wins, lambda c: c.holds(f.value(c)))
    day_hits = _holding(days, f.day_hit)
    if not literal_precedence:
        crossed = F.flatten(F.transform(long_hits, lambda a: F.transform(win_hits, lambda b: a * 100 + b)))
        return F.concat(crossed, day_hits)
    last = longs[-1].sort
    win_codes = F.array(*[F.lit(c.sort) for c in wins])
    day_codes = F.array(*[F.lit(c.sort) for c in days])
    long_codes = F.array(*[F.lit(c.sort) for c in longs])
    by_long = F.flatten(
        F.transform(
            long_hits, lambda a: F.when(a == last, F.array(a * 100)).otherwise(F.transform(win_codes, lambda b: a * 100 + b))
        )
    )
    some_wins = F.filter(win_hits, lambda b: b > 0)
    by_short = F.flatten(F.transform(some_wins, lambda b: F.transform(long_codes, lambda a: a * 100 + b)))
    # the empty long condition holds for every row, and with it all its day strategies
    return F.array_distinct(F.concat(by_long, by_short, day_codes))


def matrix_codes(version: str = "recommend") -> list[int]:
    """Codes of the strategies in the order of the columns of `strategy_matrix`."""
    longs, wins = long_conditions(version), short_win_conditions(version)
    return [a.sort * 100 + b.sort for a in longs for b in wins] + [c.sort for c in short_day_conditions()]


def strategy_matrix(value: Callable[[Condition], np.ndarray], day_hit: dict[str, np.ndarray], version: str = "recommend") -> np.ndarray:
    """Which strategies each row matches, as `matched_strategies`: rows by strategies, ones and zeros.

    `value` gives the inputs of a long or short condition (NaN: not known), `day_hit` which rows meet the day conditions.
    """
    days = short_day_conditions()
    hit = np.stack([day_hit[c.kind] for c in days], axis=1)

    def holding(conditions: list[Condition]) -> np.ndarray:
        met = np.empty((len(hit), len(conditions)))
        for i, c in enumerate(conditions):
            met[:, i] = 1 if c.kind == "none" else c.holds(value(c), True)
        return met

    longs, wins = holding(long_conditions(version)), holding(short_win_conditions(version))
    crossed = (longs[:, :, None] * wins[:, None, :]).reshape(len(hit), -1)
    return np.concatenate([crossed, hit], axis=1)


@dataclass(frozen=True)
class RecoParam:
    hole: str
    machine: str
    special_day_type: str = "none"
    score_method: str = "original"
    target_date: dt.date | None = None


_RECO_TYPES = "hole string, machine string, special_day_type string, score_method string, target_date date"
STUDY = ["hole", "machine", "special_day_type"]


def param_table(spark: SparkSession, params: DataFrame | list, kind: type, types: str) -> DataFrame:
    """Parameters as a table with the columns of `kind`.

    A table of parameters, which may grow with the venues, is used as it is; columns that it
    lacks take their default. A list becomes a local relation, so joins know its size.
    """
    schema = T.StructType.fromDDL(types)
    if not isinstance(params, DataFrame):
        return local_table(spark, sorted({tuple(getattr(p, f.name) for f in schema) for p in params}, key=str), schema)
    default = {f.name: f.default for f in fields(kind)}
    columns = [F.col(f.name) if f.name in params.columns else F.lit(default[f.name]).alias(f.name) for f in schema]
    return params.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, schema, strict=True)])


#: Rows of a task before strategies multiply them.
STUDY_ROWS = 20_000


def study_tasks(rows: DataFrame, task_rows: int = STUDY_ROWS) -> int:
    """A number of tasks that grows with the rows."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, rows.count() // task_rows + 1)


def by_study(rows: DataFrame) -> DataFrame:
    """Rows of a study in one task, in a number of tasks that grows with the rows.

    The number is given, as the size of the exchange does not show that strategies multiply the rows after it.
    """
    return rows.repartition(study_tasks(rows), *STUDY)


def diff_ranks(df: DataFrame, keys: list[str], diff: str, best: str, worst: str) -> DataFrame:
    """Rank of the 28-day diff among the units of a day, from both ends.

    A partition is one floor on one day: at most one row per unit number.
    """
    w = Window.partitionBy(*keys)
    return df.withColumns(
        {
            best: F.row_number().over(w.orderBy(F.col(diff).desc_nulls_last(), "machine_number")),
            worst: F.row_number().over(w.orderBy(F.col(diff).asc_nulls_first(), "machine_number")),
        }
    )


def outcome_totals(rows: DataFrame, keys: list[str], codes: str, diff: str, game: str) -> DataFrame:
    """Outcome totals per (keys, strategy) of rows with an array of their strategies, and the days with any.

    Beside the rows stands one row for each day with the strategies that any row of it has, which
    counts the day. So what is kept for a study is a line a strategy, not one for each of its days.
    Rows come in one order within a study, so doubles have one sum. Where rows lie in the task of
    their study, a union leaves them there.
    """
    ordered = rows.sortWithinPartitions(*keys, "target_date", "machine_number", diff, game)
    rate = payout(F.col(game), F.col(diff))
    each = ordered.select(*keys, F.col(codes).alias("__codes"), F.lit(1).alias("row"), win_flag(F.col(diff)).alias("win"), rate.alias("rate"))
    daily = rows.groupBy(*keys, "target_date").agg(F.array_distinct(F.flatten(F.collect_list(codes))).alias("__codes"))
    both = each.unionByName(daily.select(*keys, "__codes", F.lit(1).alias("day")), allowMissingColumns=True)
    spread = both.select(*keys, F.explode("__codes").alias("strategy"), "row", "win", "rate", "day")
    return spread.groupBy(*keys, "strategy").agg(
        F.count("row").alias("n"), F.sum("win").alias("wins"), F.sum("rate").alias("pay"), F.count("rate").alias("pays"), F.count("day").alias("days")
    )


def record_columns(n: Column, wins: Column, pay: Column, pays: Column, mult: Column) -> dict[str, Column]:
    win_rate, payout_rate = safe_div(wins, n), safe_div(pay, pays)
    return {
        "ref_count": (n * mult).cast("bigint"),
        "rec_win_rate": win_rate,
        "rec_payout_rate": payout_rate,
        "effectiveness": effectiveness(win_rate, payout_rate),
    }


def total_record(totals: DataFrame, keys: list[str], dedupe_strategies: bool = True) -> DataFrame:
    """Track record per strategy over all days."""
    cols = record_columns(*map(F.col, ("n", "wins", "pay", "pays")), multiplicity(F.col("strategy"), dedupe_strategies))
    return totals.withColumns(cols).select(*keys, "strategy", "days", *cols)


def unit_score_inputs(matches: DataFrame, unit_keys: list[str], filter_missing: bool, dedupe_strategies: bool = True) -> DataFrame:
    """Weighted sums per unit, over all strategies and over the effective ones.

    `matches` carries the record columns, NULL where a strategy has no record.
    The filtered methods of the back-test keep such strategies (weight 1), the
    recommendation drops them.
    """
    mult = multiplicity(F.col("strategy"), dedupe_strategies)
    eff, n = F.col("effectiveness"), F.col("ref_count")
    w = F.coalesce(n, F.lit(1)) * F.coalesce(eff, F.lit(1.0)) * mult
    parts = {
        "match_count": F.lit(1),
        "weight": w,
        "pay": w * F.coalesce("rec_payout_rate", F.lit(0.0)),
        "win": w * F.coalesce("rec_win_rate", F.lit(0.0)),
        "days": F.coalesce("days", F.lit(0)) * mult,
        "refs": F.coalesce(n, F.lit(0)) * mult,
    }
    good = (F.coalesce(eff, F.lit(1.0)) if filter_missing else F.coalesce(eff, F.lit(0.0))) >= 0.5
    rows = matches.select(*unit_keys, good.alias("__good"), *[c.alias(k) for k, c in parts.items()])
    aggs = [F.sum(k).alias(k) for k in parts]
    aggs += [F.sum(F.when(F.col("__good"), F.col(k))).alias(f"f_{k}") for k in parts]
    return rows.groupBy(*unit_keys).agg(*aggs)


_INPUTS = ["match_count", "weight", "pay", "win", "days", "refs"]


def score_parts(inputs: DataFrame, methods: list[str], group: list[str], reliability: str, filtered=fixed.FILTERED_METHODS) -> DataFrame:
    """Adds the score parts of each kind of sums."""
    w = Window.partitionBy(*group)
    kinds = sorted({"f_" if m in filtered else "" for m in methods})
    df = inputs
    for kind in kinds:
        df = df.withColumns({kind + name: column for name, column in _group_parts(kind, w).items()})
    for kind in kinds:
        df = df.withColumns({kind + name: column for name, column in _unit_parts(kind, reliability).items()})
    return df


def method_scores(
    inputs: DataFrame, methods: list[str], group: list[str], reliability: str, filtered=fixed.FILTERED_METHODS
) -> DataFrame:
    """Score parts and total score of every unit and method, within each group of units.

    Methods in `filtered` use the sums of the effective strategies; units without any get no row
    for them. The parts are worked out once for each kind of sums, and methods multiply the rows
    last: the exchange on the group serves the ranks by group and method as well.

    reliability: "absolute" steps on days and rows, or "relative" to the best
    of the group; the method `rms_reliability` always uses the steps.
    """
    df = score_parts(inputs, methods, group, reliability, filtered)
    totals = []
    for method in methods:
        kind = "f_" if method in filtered else ""
        found = total(method, *[F.col(kind + c) for c in _FACTORS])
        totals.append(F.when(F.col(kind + "match_count").isNotNull(), found))
    return spread_methods(df.withColumns({f"total{i}": c for i, c in enumerate(totals)}), methods, filtered)


def spread_methods(units: DataFrame, methods: list[str], filtered=fixed.FILTERED_METHODS) -> DataFrame:
    """A row for each method whose total (`total0`, ...) is known, with the parts of its kind of sums.

    Parts are chosen after the methods are spread: those that nobody reads are not copied for a method.
    """
    kinds = sorted({"f_" if m in filtered else "" for m in methods})
    made = [k + c for k in ("", "f_") for c in [*_INPUTS, *_PARTS]]
    keys = [c for c in units.columns if c not in made and not c.startswith(("total", "__", "f___"))]
    rows = [
        F.when(F.col(f"total{i}").isNotNull(), F.struct(F.lit(m).alias("score_method"), F.round(f"total{i}", RANK_DIGITS).alias("total_score")))
        for i, m in enumerate(methods)
    ]
    names = [*_INPUTS, *_PARTS]
    spread = units.select(*keys, *[k + c for k in kinds for c in names], F.explode(F.array_compact(F.array(*rows))).alias("s"))
    by_filter = F.col("s.score_method").isin(list(filtered))
    parts = [F.when(by_filter, F.col("f_" + c)).otherwise(F.col(c)) if len(kinds) > 1 else F.col(kinds[0] + c) for c in names]
    return spread.select(*keys, "s.score_method", *[p.alias(c) for p, c in zip(parts, names, strict=True)], "s.total_score")


#: Reliability by days and rows of the record.
STEPS, LEAST_STEP = [(30, 50, 1.0), (20, 30, 0.8), (10, 20, 0.6)], 0.4
_PARTS = ["weighted_payout_rate", "weighted_win_rate", "rms", "frequency_bonus", "reliability_score", "anomaly_bonus", "dual_high_bonus"]


def _group_parts(kind: str, w) -> dict[str, Column]:
    """Weighted rates, and the group's largest counts."""
    has, weight = F.col(kind + "weight") > 0, F.col(kind + "weight")
    return {
        "weighted_payout_rate": F.when(has, F.col(kind + "pay") / weight).otherwise(0.0),
        "weighted_win_rate": F.when(has, F.col(kind + "win") / weight).otherwise(0.0),
        "__max_m": F.max(kind + "match_count").over(w),
        "__max_r": F.max(F.col(kind + "days") + F.col(kind + "refs")).over(w),
    }


def _unit_parts(kind: str, reliability: str) -> dict[str, Column]:
    p, v = F.col(kind + "weighted_payout_rate"), F.col(kind + "weighted_win_rate")
    ps, vs = pct_score(p, _PAY), pct_score(v, _WIN)
    days, refs = F.col(kind + "days"), F.col(kind + "refs")
    max_m, max_r = F.col(kind + "__max_m"), F.col(kind + "__max_r")
    steps = F.lit(LEAST_STEP)
    for d, r, value in reversed(STEPS):
        steps = F.when((days >= d) & (refs >= r), value).otherwise(steps)
    relative = F.when(max_r > 0, F.least((days + refs) / max_r, F.lit(1.0))).otherwise(1.0)
    high_p, high_v = p > _PAY[2] * 1.05, v > _WIN[2] * 1.1
    frequency = F.least(F.sqrt(kind + "match_count") / F.sqrt(max_m), F.lit(1.0))
    return {
        "rms": F.sqrt((vs * vs + ps * ps) / 2),
        "frequency_bonus": F.when(max_m > 0, frequency).otherwise(1.0),
        "reliability_score": steps if reliability == "absolute" else relative,
        "__steps": steps,
        "anomaly_bonus": F.when(high_p & high_v, 1.1 * 1.1).when(high_p | high_v, 1.1).otherwise(1.0),
        "dual_high_bonus": F.when((p >= _PAY[1]) & (v >= _WIN[1]), 1.1).otherwise(1.0),
    }


def total(method: str, rms, steps, reliability, frequency, anomaly, dual):
    """Total score of a method from its factors: columns or arrays."""
    if method == "simple":
        return rms
    if method == "rms_reliability":
        return rms * steps
    if method in ("rms_frequency", "rms_frequency_filter"):
        return rms * frequency
    if method == "rms_frequency_anomaly":
        return rms * frequency * anomaly
    if method == "rms_frequency_dual":
        return rms * frequency * dual
    return rms * reliability * frequency * anomaly * dual


_FACTORS = ["rms", "__steps", "reliability_score", "frequency_bonus", "anomaly_bonus", "dual_high_bonus"]


@dataclass
class Recommendation:
    """Intermediate frames of a recommendation run."""

    base: DataFrame
    current: DataFrame
    record: DataFrame
    matches: DataFrame
    scores: DataFrame
    ranked: DataFrame


RATES = [f"d{n}_win_rate" for n in (3, 5, 7, 28)] + ["d28_payout_rate", "d28_diff"]


def recommend(
    mart: DataFrame,
    params: DataFrame | list[RecoParam],
    features: str = "current",
    literal_precedence: bool = False,
    dedupe_strategies: bool = True,
) -> Recommendation:
    """Ranks the units of each study for its target date.

    features: "current" takes the windows that include the latest day; "prev"
    takes, as published, those before it.  The track record always looks at the
    windows before a day and the unit's next outcome. `params` may be a table with the fields
    of `RecoParam` as columns; it can name the methods of `fixed.SCORE_METHODS`.
    """
    asked = param_table(mart.sparkSession, params, RecoParam, _RECO_TYPES)
    studies = asked.select(*STUDY, "target_date").distinct()
    cols = ["target_date", "hole", "machine", "machine_number", "d1_diff", "d1_game"]
    cols += RATES + [f"prev_{c}" for c in RATES]
    rows = mart.select(*cols).join(studies.drop("target_date").distinct(), ["hole", "machine"])
    unit = Window.partitionBy(*STUDY, "machine_number").orderBy("target_date")
    day = STUDY + ["target_date"]

    latest = latest_dates(mart, ["hole", "machine"])
    targets = studies.withColumnRenamed("target_date", "asked").join(latest, ["hole", "machine"])
    # a written table, a row a study: its size is known to the joins, which then need not deal the mart's rows again
    targets = stored(targets.select(*STUDY, F.coalesce("asked", F.date_add("latest_date", 1)).alias("next_date")))
    # the floors that are scored are read for themselves: a day of each study, not its history
    floors = targets.select(*STUDY, F.date_sub("next_date", 1).alias("target_date")).distinct()
    current = diff_ranks(rows.join(floors, day), day, "prev_d28_diff", "prev_best", "prev_worst")
    if features == "current":
        current = diff_ranks(current, day, "d28_diff", "cur_best", "cur_worst")
    current = current.join(targets.withColumn("target_date", F.date_sub("next_date", 1)), day)

    # all that follows happens in the task of the study: no exchange carries rows times strategies
    base = by_study(rows)
    # the next outcome belongs to the row, before strategies multiply it
    base = base.withColumns({"next_diff": F.lead("d1_diff").over(unit), "next_game": F.lead("d1_game").over(unit)})
    base = diff_ranks(base, day, "prev_d28_diff", "prev_best", "prev_worst")

    profile = F.col("special_day_type")
    past = Features("prev_", "prev_best", "prev_worst", F.col("target_date"), cal.special_day(profile, F.col("target_date")))
    ahead = cal.special_day(profile, F.col("next_date"))
    if features == "current":
        now = Features("", "cur_best", "cur_worst", F.col("next_date"), ahead)
    else:
        now = Features("prev_", "prev_best", "prev_worst", F.col("next_date"), ahead)

    # only units that stand there now have a say in the record
    days = targets.groupBy(*STUDY).agg(F.collect_set(F.date_sub("next_date", 1)).alias("__last_days"))
    stands = F.max(F.array_contains("__last_days", F.col("target_date"))).over(Window.partitionBy(*STUDY, "machine_number"))
    history = base.join(days, STUDY).withColumn("__stands", stands)
    history = history.where(F.col("__stands") & F.col("machine_number").isNotNull() & F.col("next_game").isNotNull())
    matched = history.select(
        *STUDY,
        "target_date",
        "machine_number",
        "next_diff",
        "next_game",
        matched_strategies(past, "recommend", literal_precedence).alias("codes"),
    )
    record = total_record(outcome_totals(matched, STUDY, "codes", "next_diff", "next_game"), STUDY, dedupe_strategies)

    matches = current.select(
        *STUDY,
        "next_date",
        "machine_number",
        F.explode(matched_strategies(now, "recommend", literal_precedence)).alias("strategy"),
    )
    scored = matches.join(record, [*STUDY, "strategy"], "left")
    unit_keys = [*STUDY, "next_date", "machine_number"]
    scored = scored.repartition(*STUDY).sortWithinPartitions(*unit_keys, "strategy")  # doubles are summed in one order
    inputs = unit_score_inputs(scored, unit_keys, False, dedupe_strategies)
    methods = fixed.SCORE_METHODS
    if not isinstance(params, DataFrame):
        methods = list(dict.fromkeys(p.score_method for p in params))
    group = [*STUDY, "score_method"]
    scores = method_scores(inputs, methods, STUDY, "absolute", ("rms_frequency_filter",))
    scores = scores.join(asked.select(*group), group, "left_semi")
    w = Window.partitionBy(*group)
    ranked = scores.withColumns(
        {
            "top1_score": F.max("total_score").over(w),
            "rank": F.row_number().over(w.orderBy(F.col("total_score").desc_nulls_last(), "machine_number")),
        }
    )
    ratio = F.try_divide("total_score", "top1_score")
    priority = None
    for step, value in fixed.PRIORITY_STEPS:
        hit = F.col("top1_ratio") >= step
        priority = F.when(hit, value) if priority is None else priority.when(hit, value)
    ranked = ranked.withColumn("top1_ratio", F.round(ratio, RANK_DIGITS)).select(
        *group,
        F.col("next_date").alias("target_date"),
        "machine_number",
        priority.otherwise(0).alias("priority_rank"),
        "total_score",
        "top1_ratio",
        "rank",
        "match_count",
        "weighted_payout_rate",
        "weighted_win_rate",
        "rms",
        "frequency_bonus",
        "reliability_score",
        "anomaly_bonus",
        "dual_high_bonus",
        "top1_score",
    )
    return Recommendation(base, current, record, matches, scores, ranked)
