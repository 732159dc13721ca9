"""Stream results kept in tables: sessions that grow, windows that late rows correct.

Spark's stateful operators show a result once it can no longer change, and drop what comes
later. These sinks keep the results in tables instead. Each micro-batch is summed up first,
joined with the few stored rows it touches, and published together with its number, so a
batch repeated after a failure changes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tripmart.frames import literal_rows
from tripmart.operators.joins import matched
from tripmart.sinks.streams import KEEP_VERSIONS, _writer
from tripmart.streaming.windows import TIME, session_count
from tripmart.tables import SnapshotTable, append, has_applied, merge, swap

# -- sessions -----------------------------------------------------------------------


def merge_sessions(
    table: SnapshotTable,
    rows: DataFrame,
    gap: str = "5 minutes",
    key: str = "PULocationID",
    time: str = TIME,
    batch: tuple[str, int] | None = None,
) -> None:
    """Add rows to a table of sessions (session_start, session_end, key, num_trips).

    The table is partitioned by ``session_end``, so only sessions that end after the earliest new
    row are read, and of those only the keys of the batch. New and stored sessions of a key are
    united where they overlap or are ``gap`` apart: in the order of their starts, a session begins
    where the furthest end so far is passed. Rows may come in any order and arbitrarily late; a
    row between two sessions joins them into one. Rows without key or time are skipped.
    """
    if table.time != "session_end":
        raise ValueError("the table is to be partitioned by session_end")
    if has_applied(table, batch):
        return
    new = table.park(session_count(rows.filter(F.col(time).isNotNull()), gap, key, time))
    first = new.agg(F.min("session_start").cast("timestamp_ntz").alias("t")).first()["t"]
    if first is None:
        return
    found = new.withColumn("_new", F.lit(True))
    if table.exists():
        near = matched(table.read_between(first), new.select(key).distinct(), [key])
        found = found.unionByName(near.withColumn("_new", F.lit(False)))
    order = Window.partitionBy(key).orderBy("session_start", "session_end")
    reach = F.max("session_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("session_start") > reach, F.lit(True)).cast("int")
    numbered = found.withColumn("_begins", begins).withColumn("_no", F.sum("_begins").over(order))
    stored = F.when(~F.col("_new"), F.struct("session_start", "session_end"))
    merged = table.park(
        numbered.groupBy(key, "_no")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("num_trips").alias("num_trips"),
            F.max("_new").alias("_touched"),
            F.collect_list(stored).alias("_stored"),
        )
        .filter("_touched")
    )
    gone = merged.select(key, F.inline("_stored"))
    swap(table, gone, merged.select(*new.columns), ["session_start", "session_end", key], batch)


def session_sink(
    df: DataFrame,
    table: SnapshotTable,
    checkpoint: str,
    gap: str = "5 minutes",
    key: str = "PULocationID",
    time: str = TIME,
    drain: bool = True,
) -> StreamingQuery:
    """Keep a table of all sessions, those still open included, as a stream of rows comes in."""

    def apply(batch: DataFrame, number: int) -> None:
        merge_sessions(table, batch, gap, key, time, (checkpoint, number))
        table.expire(KEEP_VERSIONS)

    return _writer(df, checkpoint, "append", drain).foreachBatch(apply).start()


# -- windows ------------------------------------------------------------------------

_PROGRESS = T.StructType([T.StructField("batch_no", T.LongType()), T.StructField("newest", T.TimestampNTZType())])


@dataclass
class CorrectedCounts:
    """Rows per key and window, corrected by late rows, which are also kept aside.

    Below ``root``: ``counts`` (window_start, key, num_trips, late_trips), ``late`` (the late rows
    as they came, with their batch) and ``progress`` (newest event time of each batch). The
    watermark of a batch is the newest time of the batches before it less ``delay``; a row is
    late if its window ended at or before that.
    """

    spark: SparkSession
    root: str
    width: str = "5 minutes"
    delay: dt.timedelta = dt.timedelta(seconds=5)
    key: str = "PULocationID"
    time: str = TIME

    def __post_init__(self):
        self.counts = SnapshotTable(self.spark, f"{self.root}/counts", time="window_start")
        self.late = SnapshotTable(self.spark, f"{self.root}/late", time=self.time)
        self.progress = SnapshotTable(self.spark, f"{self.root}/progress")

    def watermark(self, before: int | None = None) -> dt.datetime | None:
        """What the batches (``before`` one) have reached; None before the first."""
        if not self.progress.exists():
            return None
        rows = self.progress.read()
        rows = rows if before is None else rows.filter(F.col("batch_no") < before)
        newest = rows.agg(F.max("newest").alias("t")).first()["t"]
        return None if newest is None else newest - self.delay

    def closed(self) -> DataFrame:
        """The windows that the watermark has passed."""
        end = F.col("window_start") + F.expr(f"INTERVAL {self.width}")
        reached = F.lit(str(self.watermark())).cast("timestamp_ntz")
        return self.counts.read().filter(end.cast("timestamp_ntz") <= reached)

    def add(self, rows: DataFrame, batch: tuple[str, int]) -> None:
        """Count the rows of one batch. Rows without key or time are skipped."""
        if has_applied(self.counts, batch):
            return
        rows = rows.filter(F.col(self.key).isNotNull() & F.col(self.time).isNotNull())
        window = F.window(self.time, self.width)
        reached = self.watermark(before=batch[1])
        ended = window["end"].cast("timestamp_ntz") <= F.lit(str(reached)).cast("timestamp_ntz")
        late = F.lit(False) if reached is None else ended
        new = self.counts.park(
            rows.groupBy(window["start"].alias("window_start"), self.key, late.alias("_late")).agg(
                F.count("*").alias("_n"), F.max(self.time).cast("timestamp_ntz").alias("_newest")
            )
        )
        seen = new.agg(
            F.max("_newest").alias("newest"),
            F.bool_or("_late").alias("late"),
            F.min("window_start").cast("timestamp_ntz").alias("first"),
            F.max("window_start").cast("timestamp_ntz").alias("last"),
        ).first()
        if seen["newest"] is None:
            return
        if seen["late"]:
            append(self.late, rows.filter(late).withColumn("batch_no", F.lit(batch[1]).cast("long")), batch=batch)
        append(self.progress, literal_rows(self.spark, [(batch[1], seen["newest"])], _PROGRESS), batch=batch)
        keys = ["window_start", self.key]
        changes = new.select(
            *keys, F.col("_n").alias("num_trips"), F.when(F.col("_late"), F.col("_n")).otherwise(0).alias("late_trips")
        )
        if self.counts.exists():
            # Windows start on a grid, so those of the batch lie between its first and its last one.
            stored = self.counts.read_between(seen["first"], seen["last"] + dt.timedelta(microseconds=1))
            changes = changes.unionByName(matched(stored, new.select(*keys).distinct(), keys))
        sums = changes.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("num_trips", "late_trips")])
        merge(self.counts, sums, keys, batch=batch)

    def sink(self, df: DataFrame, checkpoint: str, drain: bool = True) -> StreamingQuery:
        """Count a stream of rows."""

        def apply(batch: DataFrame, number: int) -> None:
            self.add(batch, (checkpoint, number))
            for table in (self.counts, self.late, self.progress):
                table.expire(KEEP_VERSIONS)

        return _writer(df, checkpoint, "append", drain).foreachBatch(apply).start()
