"""Event streams: a broker topic or a folder of files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmart.functions import decode_json, from_epoch_ms, parse_time
from tripmart.functions.times import TEXT_FORMAT


def kafka_options(
    servers: str, topic: str, per_trigger: int | None = None, more: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Reader options: from the earliest offset, with further ones (security, group id)."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return {**options, **(more or {})}


def read_trip_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    topic: str | None = None,
    per_trigger: int | None = None,
    pattern: str | None = None,
    options: Mapping[str, str] | None = None,
    on_bad: str = "fail",
) -> DataFrame:
    """A stream of JSON trips, read from the beginning.

    A message that cannot be decoded stops the query; see ``decode_json`` for ``on_bad``.

    With ``topic`` the source is a broker list (the Kafka connector must be on
    the class path); otherwise a folder of files with one JSON text per line.
    Offsets are kept in the checkpoint of the query that writes the result.
    ``per_trigger`` bounds a micro-batch (messages or files), so that a large
    backlog is worked off in pieces.
    """
    if topic:
        settings = kafka_options(source, topic, per_trigger, options)
        raw = spark.readStream.format("kafka").options(**settings).load()
    else:
        reader = spark.readStream.format("text")
        if per_trigger:
            reader = reader.option("maxFilesPerTrigger", per_trigger)
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        raw = reader.load(source)
    return decode_json(raw, schema, on_bad=on_bad)


def read_bounded_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType,
    options: Mapping[str, str] | None = None,
    on_bad: str = "fail",
) -> DataFrame:
    """What a topic holds now, as a batch."""
    settings = {**kafka_options(servers, topic, more=options), "endingOffsets": "latest"}
    return decode_json(spark.read.format("kafka").options(**settings).load(), schema, on_bad=on_bad)


def trip_events(
    df: DataFrame,
    time: str = "lpep_pickup_datetime",
    fmt: str | None = TEXT_FORMAT,
    on_bad: str = "fail",
) -> DataFrame:
    """Add ``event_timestamp``: parsed text, or epoch milliseconds if ``fmt`` is None.

    A text that is no such stamp stops the query, or is NULL with ``on_bad='null'``.
    """
    stamp = from_epoch_ms(time) if fmt is None else parse_time(time, fmt)
    if fmt is not None and on_bad == "fail":
        text = F.concat(F.lit("bad time: "), F.col(time))
        stamp = F.when(F.col(time).isNotNull() & stamp.isNull(), F.raise_error(text).cast("timestamp")).otherwise(stamp)
    return df.withColumn("event_timestamp", stamp)
