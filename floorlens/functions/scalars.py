"""Scalar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

# Rates are compared and ranked after rounding to this many digits, so that the
# order in which a cluster adds doubles can never flip a rank or a threshold.
RANK_DIGITS = 9


def safe_div(a: Column, b: Column) -> Column:
    """a / b as double; NULL when b is zero or either side is NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def payout(game: Column, diff: Column) -> Column:
    """Payout rate: three coins go in per game."""
    return safe_div(game * 3 + diff, game * 3)


def win_flag(diff: Column) -> Column:
    return F.when(diff > 0, F.lit(1)).otherwise(F.lit(0))


def clean_int(text: Column) -> Column:
    """'+1,200' -> 1200; leading digits only, NULL when there are none."""
    plain = F.regexp_replace(F.trim(text), "^[+]|,", "")
    head = F.regexp_extract(F.regexp_replace(plain, "^[+]", ""), r"^\s*(-?\d+)", 1)
    simple = text.rlike("^[+]?-?[0-9][0-9,]*$")  # nearly always: one pattern instead of three
    return F.when(simple, F.translate(text, "+,", "").try_cast("bigint")).otherwise(head.try_cast("bigint"))


def make_id(date: Column, hole: Column, unit: Column, source: Column) -> Column:
    return F.concat_ws("_", date.cast("string"), hole, unit.cast("string"), source)


def round_cols(df, spec: dict[str, int]):
    return df.withColumns({c: F.round(F.col(c), n) for c, n in spec.items()})


def order_label(col: Column, values: list) -> Column:
    """1-based position of the value in a list; NULL when it is not listed."""
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), col)
    return F.when(pos > 0, pos)


def pct_score(x: Column, knots: tuple[float, float, float]) -> Column:
    """Piecewise-linear score through (p25, .25), (p50, .5), (p75, 1).

    NULL stays NULL; below zero is cut to zero.  F.greatest skips NULLs, hence
    the explicit guard.
    """
    p25, p50, p75 = (F.lit(k) for k in knots)
    below = F.greatest(F.lit(0.0), 0.25 * x / p25)
    return (
        F.when(x.isNull(), F.lit(None).cast("double"))
        .when(x >= p75, F.lit(1.0))
        .when(x >= p50, 0.5 + 0.5 * (x - p50) / (p75 - p50))
        .when(x >= p25, 0.25 + 0.25 * (x - p25) / (p50 - p25))
        .otherwise(below)
    )


def effectiveness(win: Column, pay: Column) -> Column:
    return (pct_score(win, fixed.WIN_KNOTS) + pct_score(pay, fixed.PAYOUT_KNOTS)) / 2.0


def target_date(run_ts: Column, zone: str = "Asia/Tokyo") -> Column:
    """Day before the local date of a UTC run time."""
    return F.date_sub(F.to_date(F.from_utc_timestamp(run_ts, zone)), 1)


def run_time(target: Column, zone: str = "Asia/Tokyo") -> Column:
    """UTC time of the local midnight that ends the target date."""
    return F.to_utc_timestamp(F.date_add(target, 1).cast("timestamp"), zone)


def classify_error(message: Column, title: Column | None = None) -> Column:
    """Error class by ordered containment in the page title and the message."""
    msg = F.coalesce(message, F.lit(""))
    ttl = F.lower(F.coalesce(title if title is not None else F.lit(""), F.lit("")))
    out = None
    for name, title_words, message_words in fixed.ERROR_CLASSES:
        hit = F.lit(False)
        for word in title_words:
            hit = hit | ttl.contains(word)
        for word in message_words:
            hit = hit | msg.contains(word)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("unknown")


def classify_http(status: Column) -> Column:
    return (
        F.when(status == 403, "cloudflare")
        .when(status == 404, "not_found")
        .when(status == 429, "rate_limit")
        .when(status >= 500, "server_error")
        .when(status >= 400, "client_error")
        .otherwise("unknown")
    )


def retryable_http(status: Column) -> Column:
    return F.coalesce((status == 429) | (status >= 500), F.lit(False))


def url_slug(text: Column) -> Column:
    """Percent-encode, then '%' -> '-', lower case."""
    encoded = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    return F.lower(F.replace(encoded, F.lit("%"), F.lit("-")))


def floor_slug(floor: Column) -> Column:
    low = F.lower(F.trim(floor))
    dashed = F.regexp_replace(F.regexp_replace(low, "[^a-z0-9_-]", "-"), "-+", "-")
    core = F.regexp_replace(dashed, "^-|-$", "")
    return F.when(core.isNull() | (core == ""), F.lit("1f")).otherwise(core)
