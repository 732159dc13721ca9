"""Row filters. All are plain predicates, so they reach the Parquet reader."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tripmart.functions.casts import ColumnLike, col

Moment = str | dt.datetime | dt.date


def _like(c: Column, moment: Moment, kind: str) -> Column:
    # A wall-clock literal keeps the comparison on the stored type: no cast
    # on the column, so the bound is pushed down.
    return F.lit(str(moment)).cast(kind)


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which all the columns have a value."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def in_interval(c: ColumnLike, start: Moment, end: Moment, kind: str = "timestamp_ntz") -> Column:
    """Half-open interval ``[start, end)``."""
    c = col(c)
    return (c >= _like(c, start, kind)) & (c < _like(c, end, kind))


def dev_sample(
    df: DataFrame, enabled: bool, start: Moment, end: Moment, time: str = "pickup_datetime"
) -> DataFrame:
    """The rows of ``[start, end)`` in a development run, else all rows."""
    return df.filter(in_interval(time, start, end)) if enabled else df


def on_date(c: ColumnLike, day: str | dt.date) -> Column:
    """Stamps that fall on one day."""
    return F.to_date(col(c)) == F.lit(str(day)).cast("date")


def between_dates_inclusive(c: ColumnLike, first: str | dt.date, last: str | dt.date) -> Column:
    """Stamps from the first day to the end of the last day.

    Written as a half-open range over stamps, so it prunes like F2.
    """
    end = dt.date.fromisoformat(str(last)) + dt.timedelta(days=1)
    return in_interval(c, first, end)


def having_count(df: DataFrame, count_column: str, n: int) -> DataFrame:
    """Groups whose count equals ``n``."""
    return df.filter(F.col(count_column) == n)


def new_rows_only(
    df: DataFrame, target: DataFrame, time: str, lookback: str | None = None
) -> DataFrame:
    """Rows later than the newest stamp of ``target``; all rows if it is empty.

    The comparison is strict. Late rows and rows equal to the newest stamp are
    left out unless a ``lookback`` interval ("1 day") moves the bound back.
    """
    newest = target.select(F.max(time)).scalar()
    bound = newest - F.expr(f"INTERVAL {lookback}") if lookback else newest
    return df.filter((F.col(time) > bound) | newest.isNull())
