"""Unit renumbering: a map table per venue and shift rules."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ShiftRule:
    """Units low <= n < high of a venue move by `delta` up to and including a date."""

    hole: str
    valid_to: dt.date
    low: int
    high: int
    delta: int


def remap_units(
    df: DataFrame,
    mapping: DataFrame | None = None,
    shifts: list[ShiftRule] = (),
    date: str = "date",
) -> DataFrame:
    """Replaces machine_number.

    Map rows (hole, valid_to, old_number, new_number) win; a unit that is not
    mapped keeps its number unless a shift rule covers it.  The map is joined
    without a hint: Catalyst broadcasts it when its measured size allows.
    """
    unit = F.col("machine_number")
    shifted = None
    for r in shifts:
        hit = (F.col("hole") == r.hole) & (F.col(date) <= F.lit(r.valid_to)) & (unit >= r.low) & (unit < r.high)
        value = unit + r.delta
        shifted = F.when(hit, value) if shifted is None else shifted.when(hit, value)
    fallback = unit if shifted is None else shifted.otherwise(unit)
    if mapping is None:
        return df.withColumn("machine_number", fallback)
    m = mapping.select(
        F.col("hole").alias("__hole"),
        F.col("valid_to").alias("__to"),
        F.col("old_number").alias("__old"),
        F.col("new_number").alias("__new"),
    )
    on = (df["hole"] == F.col("__hole")) & (df["machine_number"] == F.col("__old")) & (df[date] <= F.col("__to"))
    return (
        df.join(m, on, "left")
        .withColumn("machine_number", F.coalesce(F.col("__new"), fallback))
        .drop("__hole", "__to", "__old", "__new")
    )
