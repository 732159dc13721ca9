import datetime as dt
import json
import os

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.schemas import GREEN_TRIP, HOURLY_TIPS, PICKUP_COUNTS, RIDE, SESSION_COUNTS
from tripmart.session import LARGE_STATE
from tripmart.sinks import append_sink, console_sink, upsert_sink
from tripmart.sources import read_trip_stream, trip_events
from tripmart.streaming import LateRows, late_rows, running_count, session_count, tumbling_count, tumbling_sum, watermarked
from tripmart.tables import SnapshotTable, create_keyed_table

DAY = dt.datetime(2025, 10, 1)


def at(text):
    hours, minutes, seconds = (int(x) for x in text.split(":"))
    return DAY + dt.timedelta(hours=hours, minutes=minutes, seconds=seconds)


class Feed:
    """A folder of message files; each file added is one micro-batch."""

    def __init__(self, folder):
        self.folder = str(folder)
        os.makedirs(self.folder, exist_ok=True)
        self.count = 0

    def add(self, *trips):
        """Trips as (time text, zone, tip)."""
        path = f"{self.folder}/{self.count:04d}.json"
        with open(path, "w") as file:
            for time, zone, tip in trips:
                stamp = str(at(time)) if ":" in time else time
                file.write(json.dumps({"lpep_pickup_datetime": stamp, "PULocationID": zone, "tip_amount": tip}) + "\n")
        os.utime(path, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


def stream(spark, feed):
    return watermarked(trip_events(read_trip_stream(spark, feed.folder, GREEN_TRIP, per_trigger=1)))


def run(spark, feed, tmp_path, function, schema, keys, **options):
    table = create_keyed_table(spark, str(tmp_path / "result"), schema, keys, time=keys[0])
    query = upsert_sink(function(stream(spark, feed)), table, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return table.read(), query


def test_tumbling_edges_nulls_and_bad_times(spark, feed, tmp_path):
    feed.add(("00:00:00", 74, 1.0), ("00:04:59", 74, 1.0), ("00:05:00", 74, 1.0), ("00:01:00", None, 1.0), ("bad", 74, 1.0))
    feed.add(("00:20:00", 75, 1.0))
    with pytest.raises(Exception, match="bad time"):
        run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"])

    def lenient(rows):
        trips = read_trip_stream(spark, feed.folder, GREEN_TRIP, per_trigger=1)
        return tumbling_count(watermarked(trip_events(trips, on_bad="null")))

    counts, _ = run(spark, feed, tmp_path / "again", lenient, PICKUP_COUNTS, ["window_start", "PULocationID"])
    # The window of the newest row is still open.
    assert values(counts) == [(at("00:00:00"), 74, 2), (at("00:05:00"), 74, 1)]


def test_window_closes_when_the_watermark_reaches_its_end(spark, feed, tmp_path):
    feed.add(("00:01:00", 74, 1.0), ("00:05:04", 75, 1.0))
    counts, _ = run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"])
    assert counts.count() == 0
    feed.add(("00:05:05", 75, 1.0))
    counts, _ = run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"])
    assert values(counts) == [(at("00:00:00"), 74, 1)]


def test_late_rows_are_dropped_one_batch_after_the_watermark_moved(spark, feed, tmp_path):
    feed.add(("00:00:10", 1, 1.0), ("00:20:00", 9, 1.0))
    feed.add(("00:01:00", 1, 1.0))  # late, but the batch before it had no watermark yet
    feed.add(("00:02:00", 1, 1.0))  # dropped
    feed.add(("00:40:00", 9, 1.0))
    counts, query = run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"])
    assert values(counts) == [(at("00:00:00"), 1, 2), (at("00:20:00"), 9, 1)]
    assert late_rows(query) == 1


def test_late_rows_of_all_batches(spark, feed, tmp_path):
    """Spark reports the last batches only (100, here 5); the listener counts all."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    feed.add(("10:00:00", 9, 1.0))
    for _ in range(13):
        feed.add(("00:02:00", 1, 1.0))
    counter = LateRows()
    spark.streams.addListener(counter)
    try:
        counts = tumbling_count(stream(spark, feed)).writeStream.format("noop").outputMode("append")
        query = counts.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        total = counter.total(query)
    finally:
        spark.streams.removeListener(counter)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    # The first late batch comes before the watermark has moved.
    assert total == 12 and late_rows(query) <= 5


def test_all_late_batch_leaves_the_table_unchanged(spark, feed, tmp_path):
    feed.add(("00:00:10", 1, 1.0), ("01:00:00", 9, 1.0))
    counts, _ = run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"])
    before = values(counts)
    table = SnapshotTable(spark, str(tmp_path / "result"), time="window_start")
    version = table.manifest().version
    feed.add(("00:00:20", 1, 1.0), ("00:00:30", 2, 1.0))
    counts, query = run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"])
    assert values(counts) == before == [(at("00:00:00"), 1, 1)]
    assert table.manifest().version == version and late_rows(query) == 2


def test_a_long_stream_leaves_little_behind(spark, feed, tmp_path, monkeypatch):
    """Folders and manifests stay bounded over many small batches."""
    from tripmart.tables import strategies

    monkeypatch.setattr(strategies, "MAX_FOLDERS_PER_PARTITION", 5)
    for i in range(40):
        feed.add((f"00:{i:02d}:00", i, 1.0))
    rows = SnapshotTable(spark, str(tmp_path / "rows"))
    trips = trip_events(read_trip_stream(spark, feed.folder, GREEN_TRIP, per_trigger=1))
    append_sink(trips, rows, str(tmp_path / "c")).awaitTermination()
    assert sorted(r.PULocationID for r in rows.read().collect()) == list(range(40))
    assert len(rows.manifest().folders[""]) <= 6
    assert len(os.listdir(tmp_path / "rows" / "manifest")) <= 2 * 8 + 2
    assert len([n for n in os.listdir(tmp_path / "rows" / "data") if "=" in n]) <= 16


def test_empty_feed(spark, feed, tmp_path):
    feed.add()
    counts, _ = run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"])
    assert counts.count() == 0


def test_sessions(spark, feed, tmp_path):
    feed.add(("00:00:00", 1, 1.0), ("00:02:00", 2, 1.0), ("00:05:00", 1, 1.0))  # exactly 5 minutes apart
    feed.add(("00:10:01", 1, 1.0), ("00:11:00", 2, 1.0))  # 5 minutes and 1 second
    feed.add(("02:00:00", 9, 1.0))
    sessions, _ = run(spark, feed, tmp_path, session_count, SESSION_COUNTS, ["session_start", "PULocationID"])
    assert set(values(sessions)) == {
        (at("00:00:00"), at("00:10:00"), 1, 2), (at("00:02:00"), at("00:07:00"), 2, 1),
        (at("00:10:01"), at("00:15:01"), 1, 1), (at("00:11:00"), at("00:16:00"), 2, 1),
    }


def test_hourly_tips_over_a_restart(spark, feed, tmp_path):
    feed.add(("00:10:00", 1, 1.5), ("00:20:00", 2, None))
    feed.add(("00:59:00", 3, 2.0))
    run(spark, feed, tmp_path, tumbling_sum, HOURLY_TIPS, ["window_start"])
    feed.add(("00:59:59", 3, 4.0), ("02:00:00", 3, 1.0))  # the open hour goes on after the restart
    feed.add(("03:00:06", 3, 1.0))
    tips, query = run(spark, feed, tmp_path, tumbling_sum, HOURLY_TIPS, ["window_start"])
    assert values(tips) == [(at("00:00:00"), 7.5), (at("02:00:00"), 1.0)]
    tips, query = run(spark, feed, tmp_path, tumbling_sum, HOURLY_TIPS, ["window_start"])
    assert values(tips) == [(at("00:00:00"), 7.5), (at("02:00:00"), 1.0)]


def test_update_mode_keeps_the_newest_count(spark, feed, tmp_path):
    feed.add(("00:00:10", 1, 1.0))
    feed.add(("00:00:20", 1, 1.0), ("00:01:00", 2, 1.0))
    counts, _ = run(spark, feed, tmp_path, tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"], output_mode="update")
    assert values(counts) == [(at("00:00:00"), 1, 2), (at("00:00:00"), 2, 1)]


def test_replayed_batch_is_applied_once(spark, feed, tmp_path):
    feed.add(("00:00:10", 1, 1.0))
    table = SnapshotTable(spark, str(tmp_path / "events"))
    checkpoint = str(tmp_path / "checkpoint")

    def insert():
        append_sink(stream(spark, feed), table, checkpoint).awaitTermination()

    insert()
    feed.add(("00:00:20", 2, 1.0))
    insert()
    # As if the driver had died after the write and before the batch was committed.
    newest = max((n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), key=int)
    os.remove(f"{checkpoint}/commits/{newest}")
    crc = f"{checkpoint}/commits/.{newest}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    insert()
    assert values(table.read(), "PULocationID") == [(1,), (2,)]


def test_file_sink_and_console(spark, feed, tmp_path):
    feed.add(*[(f"00:00:{n:02d}", n, 1.0) for n in range(20)])
    out = str(tmp_path / "files")
    for _ in range(2):
        append_sink(stream(spark, feed), out, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(out).count() == 20
    query = console_sink(stream(spark, feed), 10)
    query.awaitTermination()
    assert "console" in query.lastProgress["sink"]["description"].lower()
    assert sum(p["sink"]["numOutputRows"] for p in query.recentProgress) == 10


def test_running_count(spark, feed, tmp_path):
    feed.add(("00:00:10", 1, 9.0), ("00:00:10", 1, None))
    feed.add(("00:00:20", 2, 5.0), ("00:00:21", 2, 5.5))
    counts = running_count(trip_events(read_trip_stream(spark, feed.folder, GREEN_TRIP)), F.col("tip_amount") > 5)
    query = counts.writeStream.outputMode("complete").format("memory").queryName("running").trigger(availableNow=True).start()
    query.awaitTermination()
    assert values(spark.table("running")) == [(4, 2)]


def test_epoch_milliseconds(spark, tmp_path):
    os.makedirs(tmp_path / "rides")
    ride = {"PULocationID": 186, "DOLocationID": 79, "trip_distance": 1.72, "total_amount": 17.31, "tpep_pickup_datetime": 1730429702000}
    (tmp_path / "rides" / "a.json").write_text(json.dumps(ride))
    rides = trip_events(read_trip_stream(spark, str(tmp_path / "rides"), RIDE), "tpep_pickup_datetime", None)
    table = SnapshotTable(spark, str(tmp_path / "out"))
    append_sink(rides, table, str(tmp_path / "checkpoint")).awaitTermination()
    assert values(table.read(), "event_timestamp") == [(dt.datetime(2024, 11, 1, 2, 55, 2),)]


def test_batch_and_stream_agree_on_closed_windows(spark, feed, tmp_path):
    trips = [(f"{i // 60 % 24:02d}:{i % 60:02d}:{i * 7 % 60:02d}", i * 13 % 5, float(i % 4)) for i in range(0, 600, 3)]
    feed.add(*trips)
    batch = spark.createDataFrame([(at(t), z, v) for t, z, v in trips], "event_timestamp timestamp, PULocationID int, tip_amount double")
    closed = max(at(t) for t, _, _ in trips) - dt.timedelta(seconds=5)
    for number, (function, schema, keys, width) in enumerate([
        (tumbling_count, PICKUP_COUNTS, ["window_start", "PULocationID"], 5),
        (session_count, SESSION_COUNTS, ["session_start", "PULocationID"], None),
        (tumbling_sum, HOURLY_TIPS, ["window_start"], 60),
    ]):
        streamed, _ = run(spark, feed, tmp_path / str(number), function, schema, keys)
        whole = function(batch)
        end = F.col("session_end") if width is None else F.col("window_start") + F.expr(f"INTERVAL {width} MINUTES")
        assert values(streamed) == values(whole.filter(end <= F.lit(closed)))


def sessions_of(seconds, gap=300):
    """Sessions of sorted seconds as (start, end, rows)."""
    found = []
    for s in seconds:
        if found and s - found[-1][1] <= gap:
            found[-1] = (found[-1][0], s, found[-1][2] + 1)
        else:
            found.append((s, s, 1))
    return [(a, b + gap, n) for a, b, n in found]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 60, 299, 300, 301, 600, 3600]), min_size=1, max_size=40))
def test_batch_sessions(spark, steps):
    seconds = [sum(steps[: i + 1]) for i in range(len(steps))]
    rows = [(DAY + dt.timedelta(seconds=s), key) for key in (1, 2) for s in seconds]
    df = spark.createDataFrame(rows, "event_timestamp timestamp, PULocationID int")
    expected = {
        (DAY + dt.timedelta(seconds=a), DAY + dt.timedelta(seconds=b), key, n)
        for a, b, n in sessions_of(seconds)
        for key in (1, 2)
    }
    assert set(values(session_count(df))) == expected


def test_hot_zone_is_counted_before_the_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "1 AS PULocationID", "timestamp_seconds(id % 3600) AS event_timestamp"
    )
    sessions = session_count(df)
    assert values(sessions, "num_trips") == [(200_000,)]
    sessions.collect()
    # 12 bins from each of 8 tasks are all that is shuffled.
    shuffles = sessions._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in shuffles and "session_window" not in shuffles


def test_state_on_disk(spark, feed, tmp_path):
    feed.add(("00:00:00", 1, 1.0), ("00:05:00", 1, 1.0), ("00:02:00", 2, 1.0))
    feed.add(("00:04:00", 1, 1.0), ("02:00:00", 9, 1.0))
    for key, value in LARGE_STATE.items():
        spark.conf.set(key, value)
    try:
        sessions, _ = run(spark, feed, tmp_path, session_count, SESSION_COUNTS, ["session_start", "PULocationID"])
    finally:
        for key in LARGE_STATE:
            spark.conf.unset(key)
    assert set(values(sessions)) == {
        (at("00:00:00"), at("00:10:00"), 1, 3), (at("00:02:00"), at("00:07:00"), 2, 1),
    }
