"""The unit-day mart: 22 trailing windows for every unit and day in one pass.

All target dates come out of the same job.  Shuffles: one to keep the newest
copy of a unit-day (pruned on the map side), one on (hole, unit, model) for the
windows.  After the first step a unit has at most one row per day, so a window
partition is bounded by the number of days read, whatever the raw volume.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators.dedupe import dedupe_latest
from ..operators.remap import remap_units
from ..session import dealt
from ..sources import schemas

LOOKBACK_DAYS = 32  # days of raw data behind each target date, the date included

_UNIT = ["hole", "machine_number", "machine"]
# running totals: sums and the numbers of values in them
_RUNNING = {
    "rows": "count(1)",
    "diffs": "count(diff)",
    "diff": "sum(diff)",
    "games": "count(game)",
    "game": "sum(game)",
    "wins": "count(win)",
    "win": "sum(win)",
}


def clean_observations(
    raw: DataFrame,
    mapping: DataFrame | None = None,
    shifts=(),
    ts: str = "timestamp",
    ties: list[str] = (),
) -> DataFrame:
    """Renumber, then keep the newest row per (date, hole, unit).

    Renumbering first makes the key unique afterwards even when two old numbers
    meet on one new number.
    """
    needed = ["date", *_UNIT, "diff", "game", "win", ts, *ties]
    slim = raw.select(*dict.fromkeys(needed))
    fixed_units = remap_units(slim, mapping, shifts)
    newest = dedupe_latest(fixed_units, ["date", "hole", "machine_number"], ts, ties)
    return newest.select("date", *_UNIT, "diff", "game", "win")


def _offsets(lookback: int) -> list[int]:
    n = schemas.TRAILING_DAYS
    return sorted({0, 1, 2, lookback, *n, *(k + 1 for k in n)})


def _measures(prefix: str, hi: str, lo: str | None) -> list[str]:
    """Window measures as SQL: the difference of two running totals."""

    def total(name):
        return f"({hi}_{name} - {lo}_{name})" if lo else f"{hi}_{name}"

    def summed(name):
        if lo is None:
            return f"{hi}_{name}"
        # a sum is NULL when the window has no non-NULL value
        return f"if({hi}_{name}s > {lo}_{name}s, {hi}_{name} - coalesce({lo}_{name}, 0), null)"

    base = prefix.removeprefix("prev_")
    diff, game = f"{prefix}_diff", f"{prefix}_game"
    out = [f"{summed('diff')} as {diff}", f"{summed('game')} as {game}"]
    if base != "d1":
        out.append(f"try_divide(cast({summed('win')} as double), cast({total('rows')} as double)) as {prefix}_win_rate")
    # diff and game are the columns named just before
    out.append(f"try_divide(cast({game} * 3 + {diff} as double), cast({game} * 3 as double)) as {prefix}_payout_rate")
    if base == "all":
        out.append(f"nullif({total('rows')}, 0) as {prefix}_days")
    return out


def unit_windows(obs: DataFrame, lookback: int = LOOKBACK_DAYS, rows: int | None = None) -> DataFrame:
    """Trailing windows for unique unit-days (date, hole, unit, model, diff, game, win).

    A window of n days ending today is R(0) - R(n), where R(k) is the running
    total of everything up to k days ago.  R(k) is a growing frame, which Spark
    advances once per row, so the cost does not depend on the window length; the
    measures are integers, so the difference is exact.

    The expressions are SQL text because several hundred of them are cheaper to
    parse than to assemble one call at a time. With `rows`, about how many there are,
    the number of tasks grows with them: the window rows are wide.
    """
    one = dealt(obs, _UNIT, rows).selectExpr(
        "*",
        "unix_date(date) as __day",
        "trunc(date, 'month') as __month",
    )
    by = ", ".join(_UNIT)

    def frame(keys, start, end):
        return f"over (partition by {keys} order by __day range between {start} and {end})"

    def until(k):
        return f"{k} preceding" if k else "current row"

    to_date = [
        f"{agg} {frame(by + ', __month', 'unbounded preceding', until(k))} as m{k}_{m}"
        for k in (0, 1)
        for m, agg in _RUNNING.items()
    ]
    running = [
        f"{agg} {frame(by, 'unbounded preceding', until(k))} as r{k}_{m}"
        for k in _offsets(lookback)
        for m, agg in _RUNNING.items()
    ]
    tenure = f"min(date) {frame(by, until(lookback - 1), 'current row')} as start_date"
    # the month windows go first, while the rows they sort are still narrow
    rolled = one.selectExpr("*", *to_date).selectExpr("*", *running, tenure)

    cols = ["diff as d1_diff", "game as d1_game"]
    cols.append("try_divide(cast(d1_game * 3 + d1_diff as double), cast(d1_game * 3 as double)) as d1_payout_rate")
    for n in schemas.TRAILING_DAYS:
        cols += _measures(f"d{n}", "r0", f"r{n}")
    cols += _measures("mtd", "m0", None)
    cols += _measures("all", "r0", f"r{lookback}")
    cols += _measures("prev_d1", "r1", "r2")
    for n in schemas.TRAILING_DAYS:
        cols += _measures(f"prev_d{n}", "r1", f"r{n + 1}")
    cols += _measures("prev_mtd", "m1", None)
    cols += _measures("prev_all", "r1", f"r{lookback}")
    return rolled.selectExpr("date", *_UNIT, "start_date", *cols)


def mart_columns(windows: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """Adds the calendar columns and puts the mart columns in order."""
    flagged = cal.with_holiday_flag(windows, "date", holidays)
    head = cal.mart_calendar(F.col("date"), F.col("is_holiday"))
    full = flagged.withColumns({"target_date": F.col("date"), "end_date": F.col("date"), **head})
    return full.select(*[F.col(f.name).cast(f.dataType) for f in schemas.MART.fields])


def build_mart(
    raw: DataFrame,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    holidays: DataFrame | None = None,
    mapping: DataFrame | None = None,
    shifts=(),
    lookback: int = LOOKBACK_DAYS,
    ts: str = "timestamp",
    ties: list[str] = (),
) -> DataFrame:
    """Mart rows for the target dates date_from..date_to (default: all dates).

    Only the asked dates and the lookback before them are read, as a partition
    filter on `date`. They are counted first, which takes no column but `date`.
    """
    if date_from is not None:
        raw = raw.where(F.col("date") >= F.lit(date_from - dt.timedelta(days=lookback - 1)))
    if date_to is not None:
        raw = raw.where(F.col("date") <= F.lit(date_to))
    windows = unit_windows(clean_observations(raw, mapping, shifts, ts, ties), lookback, raw.count())
    if date_from is not None:
        windows = windows.where(F.col("date") >= F.lit(date_from))
    return mart_columns(windows, holidays)
