"""Union and distinct."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from tripmart.frames import empty_frame


def union_aligned(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """UNION ALL of frames after aligning them to one column list."""
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in frames])


def concat_all(
    spark: SparkSession, frames: Sequence[DataFrame], schema: T.StructType
) -> DataFrame:
    """UNION ALL by name of any number of frames; an empty typed frame if none."""
    if not frames:
        return empty_frame(spark, schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Different value combinations of the columns."""
    return df.select(*columns).distinct()
