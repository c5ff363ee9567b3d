"""Small literal relations with known size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Rows held by the caller as a DataFrame.

    Goes through Arrow, so it becomes a local relation whose size Catalyst
    knows: joins with it are broadcast by that size, not by a hint.
    """
    arrow = to_arrow_schema(schema)
    cols = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(cols, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=schema)
