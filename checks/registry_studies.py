"""Registered queries: studies of pairs and groups of units, the payout forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from floorlens.functions import holidays as rules
from floorlens.plans import forecast, pairs
from floorlens.session import stored
from floorlens.sources import derived as d

#: The links of the groups: the test tables are random, so their correlations are low.
GROUP_ABOVE = 0.1


def _day_mart(s, f):
    from .registry import mart

    return mart(s, f).select("hole", "machine", "machine_number", "target_date", "d1_diff", "d1_payout_rate")


def _groups(table):
    return pairs.correlated_groups(pairs.correlated_links(table, above=GROUP_ABOVE))


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


def correlated_group_days(s, f):
    table = stored(_day_mart(s, f))
    return _rounded(pairs.group_days(table, _groups(table)))


def national_holidays(s, f):
    """Days with orders that are holidays, and their orders."""
    orders = d.table(s, f, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    days = rules.holidays(s, d.FIRST_DAY, d.LAST_DAY)
    return orders.join(days, F.col("date") == F.col("holiday_date")).groupBy("date").agg(F.count(F.lit(1)).alias("orders"))


#: Trees of the registered forecasts: the test tables are noise, which stops the boosting early.
TREES = 12


def _forecast(s, f):
    from .registry import mart
    from .registry_more import _venue_days, _venue_profile

    rows = stored(forecast.model_rows(mart(s, f), _venue_profile(), _venue_days(s, f), d.observations(s, f).count()))
    validate_from, forecast_from = forecast.split_days(rows)
    return forecast.fit(rows, validate_from, forecast_from, trees=TREES), rows, forecast_from


def forecast_scores(s, f):
    model, rows, start = _forecast(s, f)
    return forecast.forecast(model, rows, start)


def forecast_errors(s, f):
    model, rows, start = _forecast(s, f)
    return forecast.errors(forecast.forecast(model, rows, start), rows, start)


def queries():
    return {
        "same_day_partners": lambda s, f: _rounded(pairs.same_day_partners(_day_mart(s, f))),
        "next_day_successors": lambda s, f: _rounded(pairs.next_day_successors(_day_mart(s, f))),
        "correlated_groups": lambda s, f: _groups(_day_mart(s, f)),
        "correlated_group_days": correlated_group_days,
        "national_holidays": national_holidays,
        "forecast_scores": forecast_scores,
        "forecast_errors": forecast_errors,
        "feature_importance": lambda s, f: forecast.importances(_forecast(s, f)[0]),
    }
