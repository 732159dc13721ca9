"""Watermarks, tumbling windows and session windows.

Each function takes a stream or a batch. On a stream, a micro-batch drops rows
older than the watermark reached by the batch before it, and in append mode a
window appears when the watermark passes its end.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

TIME = "event_timestamp"


def watermarked(df: DataFrame, delay: str = "5 seconds", time: str = TIME) -> DataFrame:
    """Accept rows up to ``delay`` behind the newest event time."""
    if dict(df.dtypes)[time] == "timestamp_ntz":
        df = df.withColumn(time, F.col(time).cast("timestamp"))
    return df.withWatermark(time, delay)


def deduped(df: DataFrame, keys: list[str], delay: str = "1 hour", time: str = TIME) -> DataFrame:
    """The first row of each key of a stream, as long as its repeats come within ``delay``.

    A key is forgotten once the watermark (the newest event time less ``delay``) has passed its
    first row by ``delay``, so the state is bounded however long the stream runs. A repeat is dropped
    if it comes before that, in whatever batch; a later one counts as new, and one that is
    itself behind the watermark is dropped as late. NULL keys form a group. For a batch use ``dedupe_first``.
    """
    if not df.isStreaming:
        raise ValueError("a batch has no watermark: use dedupe_first")
    return watermarked(df, delay, time).dropDuplicatesWithinWatermark(keys)


class LateRows(StreamingQueryListener):
    """Counts the rows that streams drop as too late, over all their batches.

    Start it before the queries (``spark.streams.addListener``). Spark reports to it from
    another thread, so ``total`` waits for the end of a query that has stopped.
    """

    def __init__(self):
        self._dropped: dict[str, int] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        with self._news:
            name = str(event.progress.runId)
            self._dropped[name] = self._dropped.get(name, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def total(self, query: StreamingQuery, wait_seconds: float = 60.0) -> int:
        """Rows that this run of a query has dropped so far (all of them once it has ended)."""
        name = str(query.runId)
        with self._news:
            if not query.isActive and not self._news.wait_for(lambda: name in self._ended, wait_seconds):
                raise TimeoutError("the end of the query was not reported")
            return self._dropped.get(name, 0)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as too late in the last batches: Spark keeps about 100. For all, use ``LateRows``."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def tumbling_count(
    df: DataFrame, width: str = "5 minutes", key: str = "PULocationID", time: str = TIME
) -> DataFrame:
    """Rows per key and window of ``width``; rows without a key are skipped."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(F.window(time, width), key)
    return counts.agg(F.count("*").alias("num_trips")).select(
        F.col("window.start").alias("window_start"), key, "num_trips"
    )


def tumbling_sum(
    df: DataFrame,
    width: str = "1 hour",
    value: str | Column = "tip_amount",
    time: str = TIME,
    name: str = "total_tip_amount",
) -> DataFrame:
    """Sum of a value per window over all keys; rows without a value are skipped."""
    value = F.col(value) if isinstance(value, str) else value
    sums = df.filter(value.isNotNull()).groupBy(F.window(time, width))
    return sums.agg(F.sum(value).alias(name)).select(
        F.col("window.start").alias("window_start"), name
    )


def session_count(
    df: DataFrame, gap: str = "5 minutes", key: str = "PULocationID", time: str = TIME
) -> DataFrame:
    """Rows per key and session; a session ends ``gap`` after its last row.

    Rows exactly ``gap`` apart share a session.
    """
    rows = df.filter(F.col(key).isNotNull())
    if not df.isStreaming:
        return _batch_sessions(rows, gap, time, key)
    found = rows.groupBy(F.session_window(time, gap).alias("_session"), key)
    return found.agg(F.count("*").alias("num_trips")).select(
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        key,
        "num_trips",
    )


def _batch_sessions(rows: DataFrame, gap: str, time: str, key: str) -> DataFrame:
    """Sessions of a batch, from counts per key and ``gap``-wide bin.

    Rows of one bin are less than ``gap`` apart, so a bin lies in one session
    and is counted before the shuffle, however many rows a key has. What is
    left per key is bounded by the length of time, not by its rows.
    """
    step = F.expr(f"INTERVAL {gap}")
    bins = rows.groupBy(key, F.window(time, gap)).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), F.count("*").alias("_n")
    )
    order = Window.partitionBy(key).orderBy("_first")
    is_new = F.coalesce(F.col("_first") > F.lag("_last").over(order) + step, F.lit(True))
    numbered = bins.withColumn("_new", is_new.cast("int")).withColumn(
        "_no", F.sum("_new").over(order)
    )
    return (
        numbered.groupBy(key, "_no")
        .agg(
            F.min("_first").alias("session_start"),
            (F.max("_last") + step).alias("session_end"),
            F.sum("_n").alias("num_trips"),
        )
        .select("session_start", "session_end", key, "num_trips")
    )


def running_count(df: DataFrame, condition: Column) -> DataFrame:
    """Rows so far and matching rows so far (complete output mode on a stream)."""
    return df.agg(F.count("*").alias("total_count"), F.count_if(condition).alias("matching_count"))
