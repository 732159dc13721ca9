"""Queries over results that are kept current: reports that follow a fact, streams whose results can still change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmart.functions import encode_json, format_ride, month_start
from tripmart.operators import distinct_rollup as rollup
from tripmart.plans import build_fact, fact_rows, refresh_distinct, refresh_monthly
from tripmart.registry import feeds
from tripmart.registry.base import registry
from tripmart.registry.batch import _MONTHLY_CTE, _rounded_means
from tripmart.registry.events import _SESSIONS, MICROS, PAYLOAD
from tripmart.registry.feeds import plain, table
from tripmart.session import work_folder
from tripmart.sinks import CorrectedCounts, append_sink, memory_sink, session_sink
from tripmart.sources import read_trip_stream, trip_events
from tripmart.streaming import deduped
from tripmart.tables import SnapshotTable, append, merge

QUERIES, ORACLES, query = registry()

# -- reports ------------------------------------------------------------------------


@query(
    f"""WITH {_MONTHLY_CTE}
    SELECT * REPLACE ({feeds.as_doubles(
        "revenue_monthly_fare", "revenue_monthly_extra", "revenue_monthly_mta_tax",
        "revenue_monthly_tip_amount", "revenue_monthly_tolls_amount",
        "revenue_monthly_ehail_fee", "revenue_monthly_improvement_surcharge",
        "revenue_monthly_total_amount")})
    FROM monthly"""
)
def monthly_refresh(spark, sf):
    # A large first run, a small second one, and trips of three early months that come late.
    zones = feeds.zones(spark, sf)
    path = work_folder(spark, "enriched")
    feeds.trips(spark, sf).write.parquet(path)
    stamp = F.col("pickup_datetime")
    month = F.trunc(stamp.cast("date"), "month")
    late = month.isin(*[F.lit(m).cast("date") for m in ("1993-02-01", "1995-07-01", "1995-08-01")]) & F.col("trip_id").like("%7")
    trips = spark.read.parquet(path)
    fact, report = (
        SnapshotTable(spark, work_folder(spark, name), time=time, grain="month")
        for name, time in (("fact", "pickup_datetime"), ("monthly", "revenue_month"))
    )
    cut = F.lit("1998-02-10 12:00:00").cast("timestamp_ntz")
    build_fact(trips.filter(~late & (stamp < cut)), zones, fact)
    refresh_monthly(fact, report)
    build_fact(trips.filter(~late), zones, fact)
    refresh_monthly(fact, report)
    merge(fact, fact_rows(trips.filter(late), zones), ["trip_id"], key_fixes_partition=True)
    refresh_monthly(fact, report)
    return plain(_rounded_means(report.read()))


@query(
    """SELECT 'type' AS level, CAST(date_trunc('month', ts) AS DATE) AS period, event_type,
      count(DISTINCT user_id) AS unique_users FROM events GROUP BY ALL
    UNION ALL
    SELECT 'all', CAST(date_trunc('month', ts) AS DATE), NULL, count(DISTINCT user_id) FROM events GROUP BY ALL
    UNION ALL
    SELECT 'day', CAST(ts AS DATE), event_type, count(DISTINCT user_id) FROM events GROUP BY ALL"""
)
def distinct_rollup(spark, sf):
    # Sketches per day and type, in two overlapping runs; every count comes from them.
    events = SnapshotTable(spark, work_folder(spark, "events"), time="ts")
    append(events, table(spark, sf, "events").select("ts", "event_type", "user_id"))
    sketches = SnapshotTable(spark, work_folder(spark, "sketches"), time="day")
    for start, end in (("2023-12-30", "2024-01-20"), ("2024-01-15", "2024-02-10")):
        refresh_distinct(events, sketches, start, end, "user_id", ("event_type",))
    stored = sketches.read()
    month = month_start("day").alias("period")
    levels = {
        "type": rollup(stored, [month, "event_type"], "unique_users"),
        "all": rollup(stored, [month], "unique_users").withColumn("event_type", F.lit(None).cast("string")),
        "day": rollup(stored, [F.col("day").alias("period"), "event_type"], "unique_users"),
    }
    parts = [df.select(F.lit(name).alias("level"), "period", "event_type", "unique_users") for name, df in levels.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- streams ------------------------------------------------------------------------


class _Deliveries:
    """A folder of messages that grows; each delivery is drained before the next one comes."""

    def __init__(self, spark: SparkSession, sf: str, name: str):
        self.spark, self.folder = spark, work_folder(spark, name)
        self.events = table(spark, sf, "events").select(
            "event_id", "ts", F.date_format("ts", MICROS).alias("at"), F.col("user_id").cast("int").alias("user_id"), "event_type", "value"
        )

    def add(self, rows: DataFrame) -> None:
        encode_json(rows.select("at", "user_id", "event_type", "value")).write.mode("append").text(self.folder)

    def stream(self) -> DataFrame:
        return trip_events(read_trip_stream(self.spark, self.folder, PAYLOAD), "at", MICROS)


def _between(first: int, last: int):
    """Days of the month of an event."""
    return F.dayofmonth("ts").between(first, last)


@query(_SESSIONS + "SELECT session_start, session_end, CAST(user_id AS INTEGER) AS user_id, num_trips FROM sessions")
def stream_session_open(spark, sf):
    # Four batches; rows of the first days are spread over all of them, so sessions grow at both ends and join.
    given = _Deliveries(spark, sf, "growing")
    sessions = SnapshotTable(spark, work_folder(spark, "sessions"), time="session_end")
    checkpoint = work_folder(spark, "sessions-checkpoint")
    spread = F.col("event_id") % 4
    for k, days in enumerate(((9, 14), (15, 20), (21, 26), (27, 31))):
        given.add(given.events.filter(_between(*days) | (_between(1, 8) & (spread == k))))
        session_sink(given.stream(), sessions, checkpoint, "5 minutes", "user_id").awaitTermination()
    return plain(sessions.read())


_LATE = "dayofmonth(ts) <= 8 AND event_id % 40 = 7"


@query(
    f"""SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type, count(*) AS num_trips,
      count(*) FILTER ({_LATE}) AS late_trips
    FROM events
    WHERE time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)
    GROUP BY ALL"""
)
def stream_late_corrected(spark, sf):
    # Some rows of the first days come with the third delivery, long after their windows have closed.
    given = _Deliveries(spark, sf, "delayed")
    counts = CorrectedCounts(spark, work_folder(spark, "corrected"), key="event_type")
    checkpoint = work_folder(spark, "corrected-checkpoint")
    late = F.expr(_LATE)
    none = F.lit(False)
    for days, more in (((1, 8), none), ((9, 18), none), ((19, 24), late), ((25, 31), none)):
        given.add(given.events.filter((_between(*days) & ~late) | more))
        counts.sink(given.stream(), checkpoint).awaitTermination()
    return plain(counts.closed())


@query(
    """WITH sent AS (
      SELECT event_id, 'first' AS sent, 'kept' AS outcome FROM events
      UNION ALL SELECT event_id, 'twice in one batch', 'dropped' FROM events WHERE event_id % 5 = 0
      UNION ALL SELECT event_id, 'again in the next batch', 'dropped' FROM events WHERE event_id % 5 = 1
      UNION ALL SELECT event_id, 'again after the watermark', 'kept' FROM events WHERE event_id % 5 = 2)
    SELECT sent, count(*) AS n_sent, count(*) FILTER (outcome = 'kept') AS n_kept FROM sent GROUP BY sent"""
)
def stream_deduped(spark, sf):
    # Every event is sent once; some again in the same batch, in the next one, or long after it.
    events = table(spark, sf, "events").select("event_id", F.col("ts").alias("event_timestamp"))
    folder, kept = work_folder(spark, "sent"), SnapshotTable(spark, work_folder(spark, "kept"))
    checkpoint = work_folder(spark, "kept-checkpoint")
    first = events.withColumn("sent", F.lit("first"))
    again = first.filter("event_id % 5 = 2").withColumns(
        {"sent": F.lit("again after the watermark"), "event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 190 DAYS")}
    )
    clock = first.limit(1).select(
        F.lit(-1).cast("long").alias("event_id"),
        F.lit("2024-06-01").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit("clock").alias("sent"),
    )
    deliveries = (
        first.unionByName(first.filter("event_id % 5 = 0").withColumn("sent", F.lit("twice in one batch"))),
        first.filter("event_id % 5 = 1").withColumn("sent", F.lit("again in the next batch")),
        clock,  # time goes on until every event is forgotten
        again,
    )
    for rows in deliveries:
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(first.schema).parquet(folder)
        append_sink(deduped(stream, ["event_id"], "31 days"), kept, checkpoint).awaitTermination()
    sent = spark.read.parquet(folder).filter("event_id >= 0").groupBy("sent").agg(F.count("*").alias("n_sent"))
    # Which of two equal rows of a batch is kept is open: the kept ones are counted by event.
    stored = kept.read().filter("event_id >= 0").withColumn(
        "sent", F.when(F.col("sent") == "twice in one batch", "first").otherwise(F.col("sent"))
    )
    found = stored.groupBy("sent").agg(F.count("*").alias("n_kept"))
    return sent.join(found, "sent", "left").select("sent", "n_sent", F.coalesce("n_kept", F.lit(0)).cast("bigint").alias("n_kept"))


@query("SELECT least(count(*), 10) AS n_lines, least(count(*), 10) AS n_known FROM events")
def displayed_lines(spark, sf):
    # The first ten decoded messages as lines; which ones is open, each must be the line of an event.
    given = _Deliveries(spark, sf, "displayed")
    given.add(given.events)

    def lines(df: DataFrame) -> DataFrame:
        return df.select(format_ride("user_id", "event_type", "value", "value", "at").alias("line"))

    name = f"lines_{work_folder(spark, 'l')[-32:]}"
    memory_sink(lines(given.stream()), name).awaitTermination()
    known = lines(given.events).distinct().withColumn("known", F.lit(True))
    shown = spark.table(name).join(known, "line", "left")
    return shown.agg(F.count("*").alias("n_lines"), F.count("known").alias("n_known"))
