"""Session helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared storage that spark.checkpoint.dir names.

    Without it there is no place that all executors see; a session whose executors are
    the driver uses its warehouse, any other is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/floorlens"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


#: Rows that one task sorts or holds, where the rows are known.
TASK_ROWS = 250_000


def dealt(df: DataFrame, keys: list[str], rows: int | None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows with equal keys in one task, in a number of tasks that grows with `rows`, about what `df` has.

    Spark's own exchanges have a fixed number of partitions, so that their tasks grow with the
    data. Where that number does, or `rows` is not known, the exchange is left to Spark.
    """
    tasks = (rows or 0) // task_rows + 1
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
