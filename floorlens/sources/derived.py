"""Domain tables derived from the generic test tables.

Every table is computed by Spark from the whole parquet input; integers only,
so another engine gets the same values.  A venue is a run of supplier, customer
or user keys, so venues grow with the data and each keeps its density.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import holidays as rules
from ..operators.remap import ShiftRule
from . import schemas
from .local import local_table

# order that makes "newest" unique in the derived observations
TIES = ["l_partkey", "l_suppkey", "l_extendedprice"]

# the derived tables lie between these days
FIRST_DAY, LAST_DAY = dt.date(1992, 1, 1), dt.date(2002, 12, 31)

MAP_HOLE, MAP_TO = "H0", dt.date(1998, 3, 31)
MAP_PAIRS = [(n, n + 1000) for n in range(100, 110)]
SHIFTS = [ShiftRule("H1", dt.date(1998, 2, 28), 110, 120, 2000)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw unit-day rows, several copies per key."""
    part20 = "l_partkey % 20"
    day = "cast(l_shipdate as date)"
    diff = "(cast(floor(l_extendedprice) as bigint) % 6001 - 3000)"
    game = (
        "case when l_orderkey % 97 = 0 then cast(0 as bigint) when l_orderkey % 89 = 0 then null "
        "else cast(l_quantity as bigint) * 100 end"
    )
    base = table(spark, sf_dir, "lineitem").selectExpr(
        f"{day} as date",
        "concat('H', cast(l_suppkey div 50 as string)) as hole",
        f"concat('M', cast(({part20} + year({day})) % 3 as string)) as machine",
        f"cast(100 + {part20} as bigint) as machine_number",
        f"{diff} as diff",
        f"{game} as game",
        f"cast(case when {diff} > 0 then 1 else 0 end as bigint) as win",
        "concat('s', cast(l_linenumber % 2 as string)) as source",
        "cast(l_orderkey * 10 + l_linenumber as bigint) as ts",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_returnflag",
    )
    return base.withColumn(
        "id",
        F.concat_ws("_", F.col("date").cast("string"), "hole", F.col("machine_number").cast("string"), "source"),
    )


def holidays(spark: SparkSession) -> DataFrame:
    return rules.holidays(spark, FIRST_DAY, LAST_DAY)


def unit_map(spark: SparkSession) -> DataFrame:
    rows = [(MAP_HOLE, MAP_TO, old, new) for old, new in MAP_PAIRS]
    return local_table(spark, rows, schemas.REMAP)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event calendar with repeats: one row per urgent order of a rush day.

    A rush day is a venue-day on which more than a third of the orders are urgent.
    """
    orders = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate as date) as date",
        "concat('H', cast(o_custkey div 750 as string)) as hole",
        "o_orderkey",
        "o_orderpriority = '1-URGENT' as urgent",
    )
    rush = (
        orders.groupBy("date", "hole")
        .agg(F.count_if("urgent").alias("u"), F.count(F.lit(1)).alias("n"))
        .where("u * 3 > n")
        .select("date", "hole")
    )
    return orders.where("urgent").join(rush, ["date", "hole"]).select("date", "hole", F.lit("rush").alias("event"), "o_orderkey")


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (date, hole) of the event calendar."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate as date) as date",
        "concat('H', cast(o_custkey div 750 as string)) as hole",
        "o_orderpriority = '1-URGENT' as urgent",
    )
    return (
        orders.groupBy("date", "hole")
        .agg(F.count_if("urgent").alias("u"), F.count(F.lit(1)).alias("n"))
        .where("u * 3 > n")
        .select("date", "hole", F.lit("rush").alias("event"))
    )


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('H', cast(n_nationkey as string)) as name",
        "lower(n_name) as code",
        "case n_nationkey % 3 when 0 then 'high' when 1 then 'normal' else 'low' end as priority",
        "concat('R', cast(n_regionkey as string)) as region",
        "n_nationkey % 5 <> 4 as active",
        "n_nationkey % 4 = 0 as late_update",
    )


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual corrections: every returned line, one coin more, later stamp."""
    obs = observations(spark, sf_dir).where("l_returnflag = 'R'")
    return obs.selectExpr(
        "id",
        "date",
        "hole",
        "machine",
        "machine_number",
        "diff + 1 as diff",
        "game",
        "source",
        "ts + 1000000000 as ts",
        "timestamp_seconds(ts) as corrected_at",
        "concat('note ', cast(ts as string)) as notes",
        *TIES,
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'error'").selectExpr(
        "cast(event_id as string) as id",
        "cast(ts as date) as date",
        "concat('H', cast(user_id div 75 as string)) as hole",
        "case when event_id % 4 = 0 then null else concat('M', cast(event_id % 3 as string)) end as machine",
        "props as error_message",
        "ts as failed_at",
        "case event_id % 3 when 0 then 'pending' when 1 then 'resolved' else 'ignored' end as status",
        "event_id",
    )


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows from the `events` table: the source of the streaming jobs."""
    diff = "(cast(floor(value) as bigint) - 30)"
    return table(spark, sf_dir, "events").selectExpr(
        "cast(ts as date) as date",
        "concat('H', cast(user_id div 75 as string)) as hole",
        "concat('M', cast(user_id % 3 as string)) as machine",
        "cast(user_id % 40 as bigint) as machine_number",
        f"{diff} as diff",
        "cast(100 + event_id % 50 as bigint) as game",
        f"cast(case when {diff} > 0 then 1 else 0 end as bigint) as win",
        "event_type as source",
        "ts as timestamp",
        "event_id",
    )
