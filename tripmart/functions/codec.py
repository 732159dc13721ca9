"""JSON payloads of the event streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripmart.functions.casts import ColumnLike, col
from tripmart.functions.times import TEXT_FORMAT


# Fixed value: the display format of a ride.
RIDE_FORMAT = "Received: PU=%s, DO=%s, distance=%s, amount=$%.2f, pickup=%s"


BAD = "_bad_message"


def decode_json(
    df: DataFrame, schema: T.StructType, value: str = "value", on_bad: str = "fail"
) -> DataFrame:
    """Typed columns of a JSON payload (text or bytes) column.

    A message that is NULL, no JSON object or does not fit the schema fails the query (one that
    reads a decoded column; just counting messages does not decode them).
    With ``on_bad='divert'`` its text goes to the column ``_bad_message`` (NULL
    for a good message; see ``good_messages`` and ``bad_messages``), with
    ``on_bad='null'`` it becomes a row of NULLs.
    """
    if on_bad not in ("fail", "divert", "null"):
        raise ValueError(f"on_bad: {on_bad}")
    text = F.col(value).cast("string")
    wide = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_json(text, wide, {"columnNameOfCorruptRecord": BAD})
    rows = df.select(parsed.alias("_m"), text.alias("_text"))
    bad = F.when(F.col("_m").isNull() | (F.trim("_text") == ""), F.coalesce("_text", F.lit("NULL"))).otherwise(F.col(f"_m.{BAD}"))
    if on_bad == "fail":
        # The error is part of the message itself: a filter on it would be pushed below the
        # projection and parse the text once more.
        stop = F.raise_error(F.concat(F.lit("bad message: "), bad)).cast(wide)
        rows = rows.select(F.when(bad.isNotNull(), stop).otherwise(F.col("_m")).alias("_m"))
    fields = [F.col(f"_m.`{name}`").alias(name) for name in schema.names]
    return rows.select(*fields, bad.alias(BAD)) if on_bad == "divert" else rows.select(*fields)


def good_messages(decoded: DataFrame) -> DataFrame:
    """The messages that ``decode_json(on_bad='divert')`` could decode."""
    return decoded.filter(F.col(BAD).isNull()).drop(BAD)


def bad_messages(decoded: DataFrame) -> DataFrame:
    """The texts it could not."""
    return decoded.filter(F.col(BAD).isNotNull()).select(BAD)


def message_faults(decoded: DataFrame, time: str, parsed: str, key: str) -> DataFrame:
    """Messages per state: good, bad json, bad time (its text cannot be read), no time, no key."""
    state = (
        F.when(F.col(BAD).isNotNull(), "bad json")
        .when(F.col(time).isNotNull() & F.col(parsed).isNull(), "bad time")
        .when(F.col(time).isNull(), "no time")
        .when(F.col(key).isNull(), "no key")
        .otherwise("good")
    )
    return decoded.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n_messages"))


def encode_json(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    key: str | None = None,
    whole_seconds: bool = False,
) -> DataFrame:
    """A JSON ``value`` column with NULL fields kept, and a ``key`` if named.

    Stamps of both types become text with as many digits of the second as they
    need, or with none if ``whole_seconds``; ``parse_time`` reads either back.
    """

    def field(name: str) -> Column:
        if df.schema[name].dataType.typeName() not in ("timestamp", "timestamp_ntz"):
            return F.col(f"`{name}`").alias(name)
        stamp = F.date_format(name, TEXT_FORMAT) if whole_seconds else F.col(f"`{name}`").cast("string")
        return stamp.alias(name)

    fields = F.struct(*[field(c) for c in (columns or df.columns)])
    value = F.to_json(fields, {"ignoreNullFields": "false"}).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def format_ride(
    pickup: ColumnLike, dropoff: ColumnLike, distance: ColumnLike, amount: ColumnLike, time: ColumnLike
) -> Column:
    """One display line per ride, the amount with two decimals."""
    return F.format_string(
        RIDE_FORMAT,
        col(pickup),
        col(dropoff),
        col(distance).cast("string"),
        col(amount),
        col(time).cast("string"),
    )
