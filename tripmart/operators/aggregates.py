"""Aggregates. All have a partial form, so they combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripmart.functions.casts import ColumnLike, col


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Number of rows, as one row."""
    return df.agg(F.count("*").alias(name))


def count_by(df: DataFrame, *keys: ColumnLike, name: str = "n") -> DataFrame:
    """Number of rows per key."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias(name))


def count_distinct(c: ColumnLike) -> Column:
    """Exact number of different non-null values."""
    return F.countDistinct(col(c))


def count_non_null(c: ColumnLike) -> Column:
    """Number of rows with a value."""
    return F.count(col(c))


def total(c: ColumnLike) -> Column:
    """Sum."""
    return F.sum(col(c))


def date_span(df: DataFrame, time: str) -> DataFrame:
    """Earliest and latest stamp."""
    return df.agg(F.min(time).alias("first_at"), F.max(time).alias("last_at"))


def share_of(condition: Column) -> Column:
    """Share of all rows for which the condition holds (NULL counts as not)."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def conditional_count(df: DataFrame, condition: Column) -> DataFrame:
    """All rows, and the rows for which the condition holds."""
    return df.agg(F.count("*").alias("total_count"), F.count_if(condition).alias("matching_count"))


def high_water(df: DataFrame, time: str) -> object:
    """Newest stamp of a table, fetched as one value (``None`` if empty)."""
    return df.agg(F.max(time).alias("newest")).first()["newest"]
