"""Top-k reports. Sort and limit together run as a top-k per task, then a merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tripmart.functions.times import trip_hours


def head(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows (which ones is not defined)."""
    return df.limit(n)


def longest_trips(
    df: DataFrame,
    n: int = 5,
    start: str = "tpep_pickup_datetime",
    end: str = "tpep_dropoff_datetime",
    tie_break: Sequence[str] = (),
    name: str = "trip_hours",
) -> DataFrame:
    """The ``n`` trips that took longest, with both stamps and the hours."""
    return (
        df.select(*tie_break, start, end, trip_hours(start, end).alias(name))
        .orderBy(F.col(name).desc_nulls_last(), *tie_break)
        .limit(n)
    )


def rank_ascending(counts: DataFrame, count_column: str, name_column: str, n: int = 10) -> DataFrame:
    """The ``n`` rarest names: by count, then by name."""
    return counts.orderBy(F.col(count_column).asc(), F.col(name_column).asc_nulls_first()).limit(n)


def least_frequent(counts: DataFrame, count_column: str, name_column: str) -> DataFrame:
    """The rarest name; a tie is resolved by name."""
    return rank_ascending(counts, count_column, name_column, 1)


def top_windows(
    df: DataFrame, measure: str, k: int = 3, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` rows with the highest measure."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *tie_break).limit(k)
