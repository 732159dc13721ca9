"""Types that a column can grow into without losing a value."""

from __future__ import annotations

from pyspark.sql import types as T

# Whole numbers by size, with the decimal digits that the form they are stored in needs.
WHOLE = {"byte": 10, "short": 10, "integer": 10, "long": 20}
MOST_DIGITS = 38


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of a whole number or decimal."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (WHOLE[kind.typeName()], 0) if kind.typeName() in WHOLE else None


def common_type(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The smallest type that holds all values of both, ``None`` if there is none.

    Whole numbers grow to longer ones and to decimals, decimals to more digits on either side,
    ``float`` and whole numbers up to ``int`` to ``double``, dates to stamps without a zone. Every
    step keeps each value exactly, and Parquet files of the narrower type can be read as the wider one.
    """
    if old == new:
        return old
    names = old.typeName(), new.typeName()
    if set(names) <= set(WHOLE):
        sizes = list(WHOLE)
        return old if sizes.index(names[0]) >= sizes.index(names[1]) else new
    left, right = _digits(old), _digits(new)
    if left and right:
        before, after = max(left[0], right[0]), max(left[1], right[1])
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else None
    if set(names) <= {"byte", "short", "integer", "float", "double"}:
        return T.DoubleType()
    if set(names) == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    return None
