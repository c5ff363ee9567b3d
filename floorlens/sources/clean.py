"""Formatting, validation and stamping of raw rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean_int, make_id, win_flag

_INTS = {
    "machine_number": ["machine_number", "machineNumber"],
    "diff": ["diff"],
    "game": ["game"],
    "big": ["big"],
    "reg": ["reg"],
    "max_my": ["max_my", "maxMY"],
    "max_mdia": ["max_mdia", "maxMDia"],
    "win": ["win"],
}
_TEXTS = {"hole": ["hole"], "machine": ["machine"], "combined_rate": ["combined_rate", "combinedRate"]}


def _first_of(df: DataFrame, names: list[str]):
    found = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def format_raw(df: DataFrame) -> DataFrame:
    """Text rows in snake or camel naming to typed columns.

    Dates accept '/' and '-'; integers take the leading digits, thousands
    separators and a plus sign are allowed.
    """
    date = F.try_to_date(F.replace(F.col("date").cast("string"), F.lit("/"), F.lit("-")), "yyyy-MM-dd")
    return df.select(
        date.alias("date"),
        *[_first_of(df, names).alias(c) for c, names in _TEXTS.items()],
        *[clean_int(_first_of(df, names)).alias(c) for c, names in _INTS.items()],
    )


def validity(df: DataFrame) -> DataFrame:
    """Adds `errors`: the fields of a row that fail validation."""

    def empty(c):
        return F.col(c).isNull() | (F.col(c).cast("string") == "")

    checks = [F.when(empty(c), F.lit(c)) for c in ("date", "hole", "machine")]
    checks += [F.when(F.col(c).isNull(), F.lit(c)) for c in ("game", "machine_number", "diff")]
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors)."""
    checked = validity(df)
    good = F.size("errors") == 0
    return checked.where(good).drop("errors"), checked.where(~good)


def require_valid(df: DataFrame) -> DataFrame:
    """Rejects the whole batch when it is empty or any row fails."""
    bad, n = validity(df).agg(F.count_if(F.size("errors") > 0), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("empty batch")
    if bad:
        raise ValueError(f"{bad} of {n} rows fail validation")
    return df


def with_win(df: DataFrame) -> DataFrame:
    return df.withColumn("win", win_flag(F.col("diff")).cast("bigint"))


def stamp(df: DataFrame, source: str, load_ts: dt.datetime) -> DataFrame:
    """Source, load time and id; the load time is an argument, so runs repeat exactly."""
    return df.withColumns(
        {
            "source": F.lit(source),
            "timestamp": F.lit(load_ts),
            "id": make_id(F.col("date"), F.col("hole"), F.col("machine_number"), F.lit(source)),
        }
    )


def evolve(df: DataFrame, schema, defaults: dict | None = None) -> DataFrame:
    """Rows in the columns of `schema`; new columns get their default or NULL."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)
