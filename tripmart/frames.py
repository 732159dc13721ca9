"""Small frames built from values in the program."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_rows(
    spark: SparkSession, rows: Iterable[Sequence[object]], schema: T.StructType
) -> DataFrame:
    """Rows given in the program, as part of the plan.

    Unlike a frame made from a Python list, its size is known to Catalyst, so
    a lookup made of it is broadcast instead of shuffling the other side.
    """
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(
        pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema
    )


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, with types."""
    return literal_rows(spark, [], schema)
