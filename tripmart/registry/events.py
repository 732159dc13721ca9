"""Streaming queries over the events table, and the paged source.

Each one reads a stream until the input present is used up, with a checkpoint,
into a keyed table, and returns that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmart.functions import encode_json
from tripmart.operators import conditional_count, top_windows
from tripmart.registry.base import registry
from tripmart.registry.feeds import plain, table
from tripmart.session import work_folder
from tripmart.sinks import append_sink, upsert_sink
from tripmart.sources import read_trip_stream, trip_events
from tripmart.streaming import (
    running_count,
    session_count,
    tumbling_count,
    tumbling_sum,
    watermarked,
)
from tripmart.tables import SnapshotTable

QUERIES, ORACLES, query = registry()


PAYLOAD = T.StructType(
    [
        T.StructField("at", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream."""
    schema = table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return rows.withColumn("event_timestamp", F.col("ts").cast("timestamp"))


def _json_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as JSON messages, read as a stream of text files."""
    folder = work_folder(spark, "messages")
    messages = table(spark, sf, "events").select(
        F.date_format("ts", MICROS).alias("at"),
        F.col("user_id").cast("int").alias("user_id"),
        "event_type",
        "value",
    )
    encode_json(messages).write.text(folder)
    return trip_events(read_trip_stream(spark, folder, PAYLOAD), "at", MICROS)


def _drain(df: DataFrame, name: str, keys: list[str], time: str) -> DataFrame:
    spark = df.sparkSession
    result = SnapshotTable(spark, work_folder(spark, name), time=time)
    upsert_sink(df, result, work_folder(spark, f"{name}-checkpoint"), keys).awaitTermination()
    return result.read()


_LAST = "(SELECT max(ts) - INTERVAL 5 SECOND FROM events)"

_TUMBLING = f"""
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type, count(*) AS num_trips
FROM events
WHERE time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= {_LAST}
GROUP BY time_bucket(INTERVAL '5 minutes', ts), event_type"""


def _tumbling(spark: SparkSession, sf: str) -> DataFrame:
    counts = tumbling_count(watermarked(_event_stream(spark, sf)), "5 minutes", "event_type")
    return plain(_drain(counts, "tumbling", ["window_start", "event_type"], "window_start"))


@query(_TUMBLING)
def stream_tumbling(spark, sf):
    return _tumbling(spark, sf)


@query(
    f"""WITH counts AS ({_TUMBLING})
    SELECT * FROM counts ORDER BY num_trips DESC, window_start, event_type LIMIT 3"""
)
def stream_top_windows(spark, sf):
    return top_windows(_tumbling(spark, sf), "num_trips", 3, ["window_start", "event_type"])


_SESSIONS = """
WITH steps AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
    <= INTERVAL '5 minutes' THEN 0 ELSE 1 END AS is_new
  FROM events),
numbered AS (
  SELECT user_id, ts, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM steps),
sessions AS (
  SELECT min(ts) AS session_start, max(ts) + INTERVAL '5 minutes' AS session_end, user_id,
    count(*) AS num_trips
  FROM numbered GROUP BY user_id, no)
"""


@query(
    _SESSIONS
    + f"""SELECT session_start, session_end, CAST(user_id AS INTEGER) AS user_id, num_trips
    FROM sessions WHERE session_end <= {_LAST}"""
)
def stream_session(spark, sf):
    sessions = session_count(watermarked(_json_stream(spark, sf)), "5 minutes", "user_id")
    return plain(_drain(sessions, "session", ["session_start", "user_id"], "session_start"))


@query(_SESSIONS + "SELECT session_start, session_end, user_id, num_trips FROM sessions")
def batch_session(spark, sf):
    return session_count(table(spark, sf, "events"), "5 minutes", "user_id", time="ts").select(
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"),
        "user_id",
        "num_trips",
    )


@query(
    f"""SELECT date_trunc('hour', ts) AS window_start,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_tip_amount
    FROM events WHERE date_trunc('hour', ts) + INTERVAL '1 hour' <= {_LAST}
    GROUP BY date_trunc('hour', ts)"""
)
def stream_hourly(spark, sf):
    sums = tumbling_sum(
        watermarked(_event_stream(spark, sf)), "1 hour", F.col("value").cast("decimal(18,2)")
    )
    return plain(_drain(sums, "hourly", ["window_start"], "window_start"))


@query(
    """SELECT count(*) AS total_count, count(*) FILTER (value > 5) AS matching_count FROM events"""
)
def stream_running_count(spark, sf):
    # One row, replaced by every micro-batch.
    counts = running_count(_event_stream(spark, sf), F.col("value") > 5).withColumn("of", F.lit("all"))
    result = SnapshotTable(spark, work_folder(spark, "running"))
    checkpoint = work_folder(spark, "running-checkpoint")
    upsert_sink(counts, result, checkpoint, ["of"], output_mode="complete").awaitTermination()
    return result.read().drop("of")


@query(
    """SELECT count(*) AS total_count, count(*) FILTER (value > 5) AS matching_count FROM events"""
)
def stream_inserted(spark, sf):
    # Every message is inserted once, then the inserted rows are counted.
    rows = SnapshotTable(spark, work_folder(spark, "inserted"))
    events = _json_stream(spark, sf)
    append_sink(events, rows, work_folder(spark, "inserted-checkpoint")).awaitTermination()
    return conditional_count(rows.read(), F.col("value") > 5)
