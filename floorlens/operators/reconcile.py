"""Reconciliation of stored rows, listings, backups and corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import make_id, win_flag
from ..sources.clean import split_valid, stamp, with_win
from ..sources.pages import extract_units
from .dedupe import dedupe_first
from .quality import model_count

_SLICE = ["date", "hole"]
_ROWS = ["date", "hole", "machine", "machine_number", "diff", "game", "win", "source"]


def collection_decision(stored: DataFrame, listed: DataFrame, force: bool = False) -> DataFrame:
    """What to do per (date, venue): new, refresh or skip.

    `listed` has (date, hole, models): the number of models the venue lists.
    """
    saved = model_count(stored).withColumnRenamed("models", "saved")
    both = listed.withColumnRenamed("models", "listed").join(saved, _SLICE, "full")
    has = F.coalesce("saved", F.lit(0)) > 0
    action = F.when(~has, "new")
    if force:
        action = action.otherwise("refresh")
    else:
        action = action.when(F.col("saved") != F.coalesce("listed", F.lit(0)), "refresh").otherwise("skip")
    return both.select(
        *_SLICE, F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("listed", F.lit(0)).alias("listed"), action.alias("action")
    )


def sync_decision(primary: DataFrame, copy: DataFrame, force: bool = False) -> DataFrame:
    """Whether a (date, venue) has to be copied: the row counts of the stores differ."""

    def counts(df, name):
        return df.groupBy(*_SLICE).agg(F.count(F.lit(1)).alias(name))

    both = counts(primary, "primary_rows").join(counts(copy, "copy_rows"), _SLICE, "full").fillna(0)
    differs = F.lit(True) if force else F.col("primary_rows") != F.col("copy_rows")
    return both.withColumn("sync", (F.col("primary_rows") > 0) & differs)


def fallback(failed: DataFrame, backup: DataFrame, corrections: DataFrame, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that stand in, failures to record) for failed (date, venue, model).

    Backup rows first, else corrections of the same source; a model with neither
    stays a failure.
    """
    key = ["date", "hole", "machine"]
    asked = failed.select(*key).distinct()
    if source is not None:
        corrections = corrections.where(F.col("source") == source)
    rows = backup.select(*_ROWS).withColumn("origin", F.lit("backup"))
    rows = rows.unionByName(corrections.select(*_ROWS).withColumn("origin", F.lit("correction")))
    rows = rows.join(asked, key, "left_semi")
    # which origin wins is decided per model; a model of a floor and day has few rows
    first = F.min("origin").over(Window.partitionBy(*key))  # 'backup' < 'correction'
    used = rows.withColumn("__first", first).where("origin = __first").drop("__first")
    held = backup.select(*key).unionByName(corrections.select(*key))
    return used, failed.join(held, key, "left_anti")


def ingest(
    pages: DataFrame,
    failed: DataFrame,
    corrections: DataFrame,
    stored: DataFrame | None,
    listed: DataFrame | None,
    source: str,
    load_ts,
    force: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows to store, failures to record) of captured pages: the ingest as one plan.

    Pages (date, hole, machine, html) are parsed; `failed` (date, hole, machine) have none
    and take their corrections. Slices that `stored` holds completely, by the models that
    `listed` names, are skipped; without `listed` every slice is taken. Rows that fail
    validation are left out; a unit that two models claim goes to the first by name.
    Rows carry win flag, source, load time and id.
    """
    key = ["date", "hole", "machine"]
    cols = [*key, "machine_number", "diff", "game"]
    parsed = extract_units(pages, key).select(*cols)
    rows = parsed.unionByName(corrections.join(failed.select(*key).distinct(), key, "left_semi").select(*cols))
    if stored is not None and listed is not None:
        wanted = collection_decision(stored, listed, force).where("action <> 'skip'").select(*_SLICE)
        rows, failed = (x.join(wanted, _SLICE, "left_semi") for x in (rows, failed))
    good, _ = split_valid(rows)
    one = dedupe_first(good, [*_SLICE, "machine_number"], "machine", ["diff", "game"])
    return stamp(with_win(one), source, load_ts), failed.select(*key).join(corrections.select(*key), key, "left_anti")


def restore_day(corrections: DataFrame, source: str) -> DataFrame:
    """Raw rows from corrections alone, with the id of the source they replace."""
    return corrections.withColumns(
        {
            "win": win_flag(F.col("diff")).cast("bigint"),
            "id": make_id(F.col("date"), F.col("hole"), F.col("machine_number"), F.lit(source)),
            "source": F.lit(source),
        }
    )


def register_corrections(rows: DataFrame, meta: DataFrame, corrected_at) -> DataFrame:
    """Typed correction rows with win flag, stamp and link to the failure.

    `rows` (correction_id, machine_number, diff, game, big, reg, combined_rate)
    come from the pasted text; `meta` (correction_id, date, hole, machine,
    source, failure_id, notes) describes each paste.
    """
    joined = rows.join(meta, "correction_id")
    return joined.withColumns(
        {
            "win": win_flag(F.col("diff")).cast("bigint"),
            "id": make_id(F.col("date"), F.col("hole"), F.col("machine_number"), F.col("source")),
            "max_my": F.lit(0).cast("bigint"),
            "max_mdia": F.lit(0).cast("bigint"),
            "corrected_at": F.lit(corrected_at),
        }
    ).drop("correction_id")


def resolutions(meta: DataFrame, resolved_at, method: str = "manual") -> DataFrame:
    """Change set that resolves the failures the corrections name."""
    return meta.where(F.col("failure_id").isNotNull()).select(
        F.lit("update").alias("op"),
        F.col("failure_id").alias("id"),
        F.lit("resolved").alias("status"),
        F.lit(resolved_at).alias("resolved_at"),
        F.lit(method).alias("resolved_method"),
        F.lit(1).alias("seq"),
    ).distinct()
