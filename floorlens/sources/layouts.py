"""Floor grids: CSV text to classified cells, layout documents and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.scalars import floor_slug, url_slug
from . import schemas


def _cell(value: Column) -> dict[str, Column]:
    """Unit (3-4 digits from 100), structure (first keyword contained), else label."""
    number = F.when(value.rlike("^[0-9]{3,4}$"), value.cast("bigint"))
    number = F.when(number >= 100, number)
    subtype = None
    for word, kind in fixed.STRUCTURE_KEYWORDS:
        hit = value.contains(word)
        subtype = F.when(hit, kind) if subtype is None else subtype.when(hit, kind)
    kind = F.when(number.isNotNull(), "machine").when(subtype.isNotNull(), "structure").otherwise("label")
    return {
        "type": kind,
        "number": number,
        "subtype": F.when(kind == "structure", subtype),
        "label": F.when(kind == "structure", value),
        "text": F.when(kind == "label", value),
    }


def parse_layout_grid(files: DataFrame, text: str = "text", skip_cols: int = 1) -> DataFrame:
    """Cells of grid CSV files, one file per row.

    Empty lines do not count as grid rows; columns start after the skipped ones.
    Adds the grid size of the file.
    """
    keep = [c for c in files.columns if c != text]
    filled = F.filter(F.split(text, "\r?\n"), lambda line: F.length(line) > 0)
    rows = F.transform(filled, lambda line: F.transform(F.split(line, ","), lambda v: F.trim(v)))
    sized = files.select(*keep, rows.alias("__rows")).withColumns(
        {
            "grid_rows": F.size("__rows"),
            "grid_cols": F.greatest(
                F.lit(0), F.coalesce(F.array_max(F.transform("__rows", F.size)), F.lit(0)) - skip_cols
            ),
        }
    )
    lines = sized.select(*keep, "grid_rows", "grid_cols", F.posexplode("__rows").alias("row", "__v"))
    cells = lines.select(*keep, "grid_rows", "grid_cols", "row", F.posexplode("__v").alias("__c", "value"))
    cells = cells.where((F.col("__c") >= skip_cols) & (F.col("value") != ""))
    col = (F.col("__c") - skip_cols).alias("col")
    return cells.select(*keep, "grid_rows", "grid_cols", "row", col, *[c.alias(n) for n, c in _cell(F.col("value")).items()])


def filter_unit_range(cells: DataFrame, low: int, high: int) -> DataFrame:
    """Units outside the range go; structures and labels stay."""
    return cells.where((F.col("type") != "machine") | F.col("number").between(low, high))


def trim_columns(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Only the columns spanned by units, counted from zero; files without units vanish."""
    unit_col = F.when(F.col("type") == "machine", F.col("col"))
    span = cells.groupBy(*keys).agg(F.min(unit_col).alias("__lo"), F.max(unit_col).alias("__hi"))
    joined = cells.join(span, keys).where(F.col("col").between(F.col("__lo"), F.col("__hi")))
    return joined.withColumns(
        {"col": F.col("col") - F.col("__lo"), "grid_cols": F.col("__hi") - F.col("__lo") + 1}
    ).drop("__lo", "__hi")


def build_layout(cells: DataFrame, keys: list[str], updated: str, description: str = "") -> DataFrame:
    """One layout document per file (keys include hole and floor), cells in grid order.

    A document holds one floor grid, which bounds the collected cells.
    """
    fields = [f.name for f in schemas.CELL.fields]
    docs = cells.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in fields]))).alias("cells"),
        F.struct(
            F.max("grid_rows").cast("int").alias("rows"), F.max("grid_cols").cast("int").alias("cols")
        ).alias("grid"),
    )
    return docs.withColumns(
        {
            "version": F.lit("2.0"),
            "updated": F.lit(updated),
            "description": F.lit(description),
            "walls": F.array().cast("array<string>"),
        }
    )


def cell_counts(cells: DataFrame, keys: list[str]) -> DataFrame:
    kinds = {"machines": "machine", "structures": "structure", "labels": "label"}
    return cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"), *[F.count_if(F.col("type") == k).alias(n) for n, k in kinds.items()]
    )


def upgrade_layouts(df: DataFrame) -> DataFrame:
    """Default floor and version; documents without a venue are skipped."""
    named = df.where(F.col("hole").isNotNull() & (F.col("hole") != ""))
    return named.withColumns(
        {"floor": F.coalesce("floor", F.lit("1F")), "version": F.coalesce("version", F.lit("2.0"))}
    )


def with_slugs(df: DataFrame, venue_slugs: DataFrame | None = None) -> DataFrame:
    """Folder names of venue and floor; a given (hole, slug) table wins over the encoded name."""
    fallback = url_slug(F.col("hole"))
    if venue_slugs is None:
        out = df.withColumn("hole_slug", fallback)
    else:
        out = df.join(venue_slugs.select("hole", F.col("slug").alias("__s")), "hole", "left")
        out = out.withColumn("hole_slug", F.coalesce("__s", fallback)).drop("__s")
    return out.withColumn("floor_slug", floor_slug(F.col("floor")))


def validate_layouts(df: DataFrame, hole: str | None = None, floor: str | None = None) -> DataFrame:
    """Adds `problems`: missing parts, or a venue or floor other than asked."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in ("version", "hole", "grid", "cells")]
    if hole is not None:
        checks.append(F.when(F.col("hole") != hole, F.lit("other hole")))
    if floor is not None:
        checks.append(F.when(F.col("floor") != floor, F.lit("other floor")))
    return df.withColumn("problems", F.array_compact(F.array(*checks)))
