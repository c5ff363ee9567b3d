"""Tab-separated pastes to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.scalars import clean_int


def parse_tsv(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per unit line of each text; other columns are kept.

    Header and average lines and lines without a positive unit number are
    dropped.  Missing counts are zero.
    """
    keep = [c for c in df.columns if c != text]
    lines = df.select(*keep, F.posexplode(F.split(F.trim(F.col(text), F.lit(" \t\r\n")), "\n")).alias("line", "__l"))
    cells = lines.withColumn("__c", F.split("__l", "\t"))
    first = F.trim(F.get("__c", F.lit(0)))

    def number(i):
        raw = F.trim(F.get("__c", F.lit(i)))
        return clean_int(F.when(raw.isNull() | (raw == ""), "0").otherwise(raw))

    rate = F.trim(F.coalesce(F.get("__c", F.lit(5)), F.lit("")), F.lit(" \r"))
    wanted = (first != "") & ~first.isin(fixed.PAGE_HEADERS[0], fixed.AVERAGE_ROW)
    return (
        cells.where(wanted)
        .select(
            *keep,
            "line",
            clean_int(first).alias("machine_number"),
            number(1).alias("diff"),
            number(2).alias("game"),
            number(3).alias("big"),
            number(4).alias("reg"),
            rate.alias("combined_rate"),
        )
        .where("machine_number > 0")
    )
