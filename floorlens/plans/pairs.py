"""Studies of pairs of units of one floor: same-day correlation, next-day rotation, groups.

A floor is the units of one model in one venue. Its units are dealt into blocks; two blocks
meet in one row, their days become matrices (days x units), and matrix products give the sums
of all pairs at once. A row gives back one line a unit, its best partner in the other block,
so no pair is ever a row, but for the links that a study asks for by a threshold.

Bounds: a unit has one row a day, so its days are an array of some thousand at most; a block
has `BLOCK` units. A floor of n units is (n / BLOCK)^2 / 2 rows, which any task can take.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.scalars import RANK_DIGITS
from ..operators.components import components

FLOOR = ["hole", "machine"]
UNIT = [*FLOOR, "machine_number"]
BLOCK = 64


def met_blocks(mart: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (hole, machine, same, left, right): pairs of blocks of a floor, each pair once, and each
    block with itself. A block is an array of (number, days), days of (day, payout, sign of the
    difference). Rows without a day or a unit number are left out."""
    day = cal.day_num(F.col("target_date")).alias("day")
    rows = mart.where("target_date is not null and machine_number is not null")
    rows = rows.select(*UNIT, F.struct(day, F.col("d1_payout_rate").alias("payout"), F.signum("d1_diff").alias("sign")).alias("d"))
    units = rows.groupBy(*UNIT).agg(F.collect_list("d").alias("days"))
    place = F.row_number().over(Window.partitionBy(*FLOOR).orderBy("machine_number")) - 1
    units = units.withColumn("block", F.floor(place / block).cast("int"))
    blocks = units.groupBy(*FLOOR, "block").agg(F.sort_array(F.collect_list(F.struct(F.col("machine_number").alias("number"), "days"))).alias("units"))
    other = blocks.select(*[F.col(c).alias(f"__{c}") for c in FLOOR], F.col("block").alias("__block"), F.col("units").alias("right"))
    on = (F.col("block") <= F.col("__block")) & F.col("hole").eqNullSafe(F.col("__hole")) & F.col("machine").eqNullSafe(F.col("__machine"))
    return blocks.join(other, on).select(*FLOOR, (F.col("block") == F.col("__block")).alias("same"), F.col("units").alias("left"), "right")


@dataclass(frozen=True)
class Block:
    """Units of a block and all their days, one after another: `unit` is the place in `numbers`."""

    numbers: list[int]
    unit: np.ndarray
    day: np.ndarray
    payout: np.ndarray  # nan: not known
    sign: np.ndarray  # 0: not known

    @classmethod
    def of(cls, units: pa.ListScalar) -> Block:
        """From the Arrow value, whose buffers hold the days as columns already."""
        days = units.values.field("days")
        flat = days.flatten()
        unit = np.repeat(np.arange(len(days)), days.value_lengths().to_numpy(zero_copy_only=False))
        payout, sign = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("payout", "sign"))
        return cls(units.values.field("number").to_pylist(), unit, flat.field("day").to_numpy(), payout.astype(float), np.nan_to_num(sign.astype(float)))


def _matrices(block: Block, first: int, days: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Present, payout known, payout less the unit's mean (0 where unknown), sign: each days x units."""
    there, known, payout, sign = (np.zeros((days, len(block.numbers))) for _ in range(4))
    at, has = (block.day - first, block.unit), ~np.isnan(block.payout)
    count = np.bincount(block.unit[has], minlength=len(block.numbers))
    mean = np.bincount(block.unit[has], block.payout[has], len(block.numbers)) / np.maximum(count, 1)
    there[at] = 1
    known[at] = has
    payout[at] = np.where(has, block.payout - mean[block.unit], 0)
    sign[at] = block.sign
    return there, known, payout, sign


def _days(*sides: Block) -> tuple[int, int]:
    first, last = min(int(b.day.min()) for b in sides), max(int(b.day.max()) for b in sides)
    return first, last - first + 1


def correlations(left: Block, right: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common days, correlation of payouts (nan without spread) and common wins of all pairs."""
    first, days = _days(left, right)
    p, m, x, s = _matrices(left, first, days)
    q, k, y, t = _matrices(right, first, days)
    n = m.T @ k
    sx, sy, sxy = x.T @ k, m.T @ y, x.T @ y
    sxx, syy = (x * x).T @ k, m.T @ (y * y)
    with np.errstate(divide="ignore", invalid="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        r = (sxy - sx * sy / n) / np.sqrt(vx * vy)
    r[(n < 2) | (vx <= 1e-12 * sxx) | (vy <= 1e-12 * syy)] = np.nan
    return p.T @ q, np.round(r, RANK_DIGITS), (s > 0).astype(float).T @ (t > 0).astype(float)


def rotations(left: Block, right: Block) -> tuple[np.ndarray, ...]:
    """Counts for pairs (unit of `left` on a day, unit of `right` on the next): days, days after a win,
    wins after a win, days after a loss, wins after a loss."""
    first, days = _days(left, right)
    p, _, _, s = _matrices(left, first, days)
    q, _, _, t = _matrices(right, first, days)
    p, s, q, t = p[:-1], s[:-1], q[1:], t[1:]
    won, lost, wins = (s > 0).astype(float), (s < 0).astype(float), (t > 0).astype(float)
    return p.T @ q, won.T @ q, won.T @ wins, lost.T @ q, lost.T @ wins


def _over_blocks(mart: DataFrame, study: Callable, schema: str, block: int) -> DataFrame:
    """Rows (hole, machine, ...) of `study(left, right, same)`, a list of tuples, for each pair of blocks."""
    met = met_blocks(mart, block)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in met.schema.fields[:2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left, same = Block.of(batch["left"][i]), batch["same"][i].as_py()
                rows = study(left, left if same else Block.of(batch["right"][i]), same)
                if rows:
                    floor = [pa.array([batch[c][i].as_py()] * len(rows), batch.schema.field(c).type) for c in FLOOR]
                    names = [*FLOOR, *(x.split()[0] for x in schema.split(", "))]
                    types = [_ARROW[x.split()[1]] for x in schema.split(", ")]
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.record_batch([*floor, *columns], names=names)

    return met.mapInArrow(run, f"{kinds}, {schema}")


_ARROW = {"long": pa.int64(), "double": pa.float64()}


def _best_first(value: str, partner: str) -> Column:
    """Orders structs so that the least has the largest value, then the lowest partner; no value comes last."""
    return F.struct(F.col(value).isNull().alias("none"), (-F.col(value)).alias("minus"), F.col(partner).alias("partner"))


def same_day_partners(mart: DataFrame, least_days: int = 30, strong: float = 0.5, block: int = BLOCK) -> DataFrame:
    """For each unit with a partner of at least `least_days` common days: number of such partners,
    number with a correlation of payouts above `strong`, and the partner of the highest correlation
    (ties: lowest number) with its correlation, common days and rate of days on which both won.

    A partner is another unit of the floor; correlations use days on which both payouts are known
    and are rounded to nine digits before they are compared.
    """

    def study(left: Block, right: Block, same: bool) -> list[tuple]:
        days, r, wins = correlations(left, right)
        if same:
            np.fill_diagonal(days, 0)
        out = []
        sides = [(left, right, days, r, wins)] + ([] if same else [(right, left, days.T, r.T, wins.T)])
        for units, others, n, c, w in sides:
            for i, unit in enumerate(units.numbers):
                near = np.flatnonzero(n[i] >= least_days)
                if len(near):
                    order = np.where(np.isnan(c[i, near]), -2, c[i, near])
                    j = near[int(order.argmax())]  # the first of equal ones: units are in order of number
                    value = None if np.isnan(c[i, j]) else float(c[i, j])
                    above = int((order > strong).sum())
                    out.append((unit, len(near), above, others.numbers[j], value, int(n[i, j]), int(w[i, j])))
        return out

    schema = "machine_number long, near long, above long, partner long, correlation double, days long, wins long"
    rows = _over_blocks(mart, study, schema, block)
    best = F.min(F.struct(_best_first("correlation", "partner").alias("order"), "days", "wins")).alias("best")
    out = rows.groupBy(*UNIT).agg(F.sum("near").alias("partners"), F.sum("above").alias("strong_partners"), best)
    return out.select(
        *UNIT,
        "partners",
        "strong_partners",
        F.col("best.order.partner").alias("best_partner"),
        (-F.col("best.order.minus")).alias("best_correlation"),
        F.col("best.days").alias("common_days"),
        (F.col("best.wins") / F.col("best.days")).alias("both_win_rate"),
    )


def correlated_links(mart: DataFrame, least_days: int = 30, above: float = 0.5, block: int = BLOCK) -> DataFrame:
    """Rows (hole, machine, a, b, correlation): pairs a < b above the threshold, the links of the groups."""

    def study(left: Block, right: Block, same: bool) -> list[tuple]:
        days, r, _ = correlations(left, right)
        hit = (days >= least_days) & (np.nan_to_num(r, nan=-2) > above)
        if same:
            hit = np.triu(hit, 1)
        return [(left.numbers[i], right.numbers[j], float(r[i, j])) for i, j in zip(*np.nonzero(hit), strict=True)]

    return _over_blocks(mart, study, "a long, b long, correlation double", block)


def next_day_successors(mart: DataFrame, least_days: int = 30, block: int = BLOCK) -> DataFrame:
    """For each unit with a successor of at least `least_days` pairs of days: their number and the one
    that wins most often on the day after the unit lost (rotation; ties: lowest number), with that
    rate, its rate after the unit won, and the pairs of days.

    A unit is also its own successor. A pair of days is a day of the unit and the next calendar
    day of the successor. A rate without any such day is null and comes last.
    """

    def study(left: Block, right: Block, same: bool) -> list[tuple]:
        out = []
        for units, others in [(left, right)] + ([] if same else [(right, left)]):
            n, after_win, win_win, after_loss, loss_win = rotations(units, others)
            with np.errstate(divide="ignore", invalid="ignore"):
                rate, again = np.round(loss_win / after_loss, RANK_DIGITS), win_win / after_win
            for i, unit in enumerate(units.numbers):
                near = np.flatnonzero(n[i] >= least_days)
                if len(near):
                    j = near[int(np.nan_to_num(rate[i, near], nan=-1).argmax())]
                    values = [None if np.isnan(x) else float(x) for x in (rate[i, j], again[i, j])]
                    out.append((unit, len(near), others.numbers[j], *values, int(n[i, j])))
        return out

    schema = "machine_number long, near long, successor long, rotation double, again double, days long"
    rows = _over_blocks(mart, study, schema, block)
    best = F.min(F.struct(_best_first("rotation", "successor").alias("order"), "again", "days")).alias("best")
    return rows.groupBy(*UNIT).agg(F.sum("near").alias("successors"), best).select(
        *UNIT,
        "successors",
        F.col("best.order.partner").alias("best_successor"),
        (-F.col("best.order.minus")).alias("rotation_rate"),
        F.col("best.again").alias("next_day_win_rate"),
        F.col("best.days").alias("day_pairs"),
    )


def correlated_groups(links: DataFrame) -> DataFrame:
    """Rows (hole, machine, machine_number, group_id, group_size): units joined by links, directly or
    through others; `group_id` is the lowest unit number of the group."""
    found = components(links, FLOOR, "a", "b")
    sizes = found.groupBy(*FLOOR, F.col("label").alias("group_id")).agg(F.count(F.lit(1)).alias("group_size"))
    sizes = sizes.withColumnsRenamed({c: f"__{c}" for c in FLOOR})
    on = (F.col("label") == F.col("group_id")) & F.col("hole").eqNullSafe(F.col("__hole")) & F.col("machine").eqNullSafe(F.col("__machine"))
    return found.join(sizes, on).select(*FLOOR, F.col("node").alias("machine_number"), "group_id", "group_size")


def group_days(mart: DataFrame, groups: DataFrame) -> DataFrame:
    """Mean payout and win rate of each group and day, and those of the group's day before
    (`group_momentum`): what a following group can be judged by."""
    names = groups.withColumnsRenamed({c: f"__{c}" for c in UNIT})
    on = F.col("hole").eqNullSafe(F.col("__hole")) & F.col("machine").eqNullSafe(F.col("__machine"))
    rows = mart.join(names, on & (F.col("machine_number") == F.col("__machine_number")))
    days = rows.groupBy(*FLOOR, "group_id", "target_date").agg(
        F.count(F.lit(1)).alias("units"),
        F.round(F.avg("d1_payout_rate"), RANK_DIGITS).alias("avg_payout_rate"),
        F.avg((F.col("d1_diff") > 0).cast("double")).alias("win_rate"),
    )
    order = Window.partitionBy(*FLOOR, "group_id").orderBy("target_date")
    return days.withColumn("group_momentum", F.lag("avg_payout_rate").over(order))
