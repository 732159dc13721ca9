"""Casts and defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_cast(c: ColumnLike, kind: str | T.DataType) -> Column:
    """Cast that fails the query on bad text (ANSI mode)."""
    return col(c).cast(kind)


def safe_cast(c: ColumnLike, kind: str | T.DataType) -> Column:
    """Cast that yields NULL on bad text."""
    return col(c).try_cast(kind)


def safe_int(c: ColumnLike) -> Column:
    """Text to number to integer: ``'1.0'`` is 1, halves round away from zero.

    Spark truncates a fractional value on the way to an integer, so it is
    rounded first.
    """
    return F.round(col(c).try_cast("double")).try_cast("int")


def default_to(c: ColumnLike, value: object) -> Column:
    """The column, or a constant where it is NULL."""
    return F.coalesce(col(c), F.lit(value))
