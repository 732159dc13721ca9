"""Time arithmetic. Stamps are wall-clock (``timestamp_ntz``) or UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tripmart.functions.casts import ColumnLike, col

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def trip_hours(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole seconds between two stamps, in hours."""
    return (F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / 3600


def trip_duration_minutes(start: ColumnLike, end: ColumnLike) -> Column:
    """Number of minute boundaries crossed: 00:00:59 to 00:01:00 is 1.

    For stamps from 1970 on; independent of the session time zone.
    """

    def minute(c: ColumnLike) -> Column:
        return F.floor(F.unix_timestamp(col(c)) / 60)

    return (minute(end) - minute(start)).cast("bigint")


def month_start(c: ColumnLike) -> Column:
    """First day of the month, as a date."""
    return F.trunc(col(c).cast("date"), "month")


# A stamp with a space or T, and up to six digits of the second.
STAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def parse_time(c: ColumnLike, fmt: str = TEXT_FORMAT) -> Column:
    """Text to timestamp; bad text is NULL.

    The default format also takes ``T`` in the middle and a fraction of the second.
    """
    if fmt == TEXT_FORMAT:
        return F.when(col(c).rlike(STAMP), col(c).try_cast("timestamp"))
    return F.try_to_timestamp(col(c), F.lit(fmt))


def as_text(c: ColumnLike, fmt: str = TEXT_FORMAT) -> Column:
    """Stamp to text."""
    return F.date_format(col(c), fmt)


def epoch_ms(c: ColumnLike) -> Column:
    """Milliseconds since 1970 (UTC)."""
    return F.unix_millis(col(c).cast("timestamp"))


def from_epoch_ms(c: ColumnLike) -> Column:
    """Timestamp of a millisecond count since 1970 (UTC)."""
    return F.timestamp_millis(col(c))
