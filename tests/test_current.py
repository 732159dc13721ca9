"""Results that are kept current: monthly reports, distinct counts, sessions, corrected windows."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan, values
from tests.test_streaming import DAY, Feed, at
from tripmart.operators import distinct, distinct_rollup, distinct_sketches
from tripmart.plans import monthly_zone_revenue, refresh_distinct, refresh_monthly
from tripmart.plans.current import changed_months, months_of
from tripmart.schemas import FACT, GREEN_TRIP
from tripmart.sinks import CorrectedCounts, append_sink, merge_sessions, session_sink
from tripmart.sources import read_trip_stream, trip_events
from tripmart.streaming import deduped, session_count, tumbling_count
from tripmart.tables import SnapshotTable, append, merge, replace, replace_partitions, swap

ROWS = "k int, v string, t timestamp_ntz"
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


# -- tables ---------------------------------------------------------------------------


def test_swap(spark, root):
    table = SnapshotTable(spark, root, time="t")
    with pytest.raises(ValueError, match="time of the table"):
        swap(table, None, None, ["k"])
    append(table, spark.createDataFrame([(1, "a", day(1)), (2, "b", day(1)), (1, "c", day(2)), (5, "e", None)], ROWS))
    before = table.manifest().folders
    gone = spark.createDataFrame([(1, day(1)), (9, day(1)), (2, day(7))], "k int, t timestamp_ntz")
    swap(table, gone, spark.createDataFrame([(3, "new", day(3))], ROWS), ["k", "t"], batch=("s", 4))
    swap(table, gone, spark.createDataFrame([(8, "again", day(3))], ROWS), ["k", "t"], batch=("s", 4))
    assert values(table.read()) == [(1, "c", day(2)), (2, "b", day(1)), (3, "new", day(3)), (5, "e", None)]
    after = table.manifest().folders
    assert {p for p in before if after[p] == before[p]} == set(before) - {"part_from=2024-01-01"}


def test_replace_partitions(spark, root):
    table = SnapshotTable(spark, root, time="t")
    append(table, spark.createDataFrame([(1, "a", day(1)), (2, "b", day(2)), (3, "c", None)], ROWS))
    names = ["part_from=2024-01-01", "part_from=2024-01-02"]
    with pytest.raises(ValueError, match="not replaced"):
        replace_partitions(table, spark.createDataFrame([(1, "x", day(3))], ROWS), names)
    replace_partitions(table, spark.createDataFrame([(1, "x", day(2))], ROWS), names, batch=("s", 1))
    assert values(table.read()) == [(1, "x", day(2)), (3, "c", None)]
    version = table.manifest().version
    replace_partitions(table, table.read().limit(0), names, batch=("s", 1))
    assert table.manifest().version == version and table.manifest(version - 1).version == version - 1
    assert table.manifest(99) is None


# -- monthly report ---------------------------------------------------------------------


def trip(n, stamp, zone="A", amount=1):
    row = {f.name: None for f in FACT.fields}
    row.update(trip_id=str(n), pickup_datetime=stamp, pickup_zone=zone, service_type="Green", total_amount=amount, fare_amount=amount)
    return tuple(row[f.name] for f in FACT.fields)


def trips(spark, *rows):
    from decimal import Decimal

    kinds = FACT
    fixed = [tuple(Decimal(v) if isinstance(v, int) and f.dataType.typeName() == "decimal" else v for v, f in zip(r, kinds.fields)) for r in rows]
    return spark.createDataFrame(fixed, kinds)


@pytest.fixture(params=["day", "month"])
def fact(request, spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "fact"), "pickup_datetime", request.param)
    append(table, trips(spark, *[trip(i, dt.datetime(2024, 1 + i % 6, 1 + i, i)) for i in range(18)], trip(99, None)))
    return table


@pytest.fixture
def report(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "report"), "revenue_month", "month")


def month(n):
    return f"part_from=2024-{n:02d}-01"


def check(fact, report):
    assert values(report.read()) == values(monthly_zone_revenue(fact.read()))


def test_only_months_that_changed_are_computed(spark, fact, report):
    assert refresh_monthly(fact, report) == {*map(month, range(1, 7)), "part_from=__HIVE_DEFAULT_PARTITION__"}
    check(fact, report)
    version = report.manifest().version
    assert refresh_monthly(fact, report) == set() and report.manifest().version == version
    first = report.manifest().folders
    before = fact.manifest()
    append(fact, trips(spark, trip(50, dt.datetime(2024, 2, 1), "B"), trip(51, dt.datetime(2024, 9, 9))))
    changed = changed_months(before, fact.manifest())
    assert changed == {month(2), month(9)}
    # Of the fact, only folders of these months are scanned.
    text = plan(months_of(fact, changed))
    opened = sum(len(f) for p, f in fact.manifest().folders.items() if p.startswith(("part_from=2024-02", "part_from=2024-09")))
    assert f"InMemoryFileIndex({opened} paths)" in text and opened < sum(map(len, fact.manifest().folders.values()))
    assert refresh_monthly(fact, report) == changed
    check(fact, report)
    again = report.manifest().folders
    assert {p for p in first if again[p] == first[p]} == set(first) - {month(2)}


def test_corrections_deletions_and_a_rebuilt_fact(spark, fact, report):
    refresh_monthly(fact, report)
    merge(fact, trips(spark, trip(4, dt.datetime(2024, 5, 5, 4), "C", 7)), ["trip_id"], key_fixes_partition=True)
    assert refresh_monthly(fact, report) == {month(5)}
    check(fact, report)
    march = [p for p in fact.manifest().folders if "2024-03" in p]
    replace_partitions(fact, fact.read().limit(0), march)
    assert refresh_monthly(fact, report) == {month(3)}
    assert month(3) not in report.manifest().folders
    check(fact, report)
    replace(fact, trips(spark, trip(1, dt.datetime(2024, 6, 6))))
    assert month(1) in refresh_monthly(fact, report)
    check(fact, report)
    assert report.read().count() == 1


def test_a_forgotten_version_means_all_months(spark, fact, report):
    refresh_monthly(fact, report)
    for i in range(3):
        append(fact, trips(spark, trip(60 + i, dt.datetime(2024, 4, 4))))
    fact.expire(keep=1)
    assert {month(1), month(4)} <= refresh_monthly(fact, report)
    check(fact, report)


def test_layouts_that_cannot_be_refreshed(spark, fact, report, tmp_path):
    with pytest.raises(ValueError, match="partitioned"):
        refresh_monthly(SnapshotTable(spark, str(tmp_path / "plain")), report)
    with pytest.raises(ValueError, match="partitioned"):
        refresh_monthly(fact, SnapshotTable(spark, str(tmp_path / "days"), "revenue_month"))
    with pytest.raises(FileNotFoundError):
        refresh_monthly(SnapshotTable(spark, str(tmp_path / "none"), "pickup_datetime"), report)


# -- distinct counts ---------------------------------------------------------------------


def test_sketches_count_exactly(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(d, rng.choice("ab"), v) for d in range(6) for v in [rng.choice([0, 1, -1, -40_000, 32_767, 32_768, 32_769, 2**62, None, rng.randrange(100)]) for _ in range(80)]]
    df = spark.createDataFrame(rows, "d int, k string, v long")
    for limit in (0, 3, 512, 10**6):
        monkeypatch.setattr(distinct, "LISTED", limit)
        sketches = distinct_sketches(df, ["d", "k"], "v")
        for keys in (["d", "k"], ["k"], []):
            wanted = {}
            for d, k, v in rows:
                wanted.setdefault(tuple({"d": d, "k": k}[x] for x in keys), set()).add(v)
            found = {tuple(r[x] for x in keys): r.n_distinct for r in distinct_rollup(sketches, keys).collect()}
            assert found == {k: len(v - {None}) for k, v in wanted.items()}
    assert sketches.filter("listed IS NULL").count() == 0


def test_forms_of_a_sketch(spark):
    df = spark.range(0, 2_000).select(F.lit(1).alias("k"), "id").unionByName(spark.range(5).select(F.lit(2).alias("k"), "id"))
    rows = {r.k: r for r in distinct_sketches(df, ["k"], "id").filter("bucket = 1").collect()}
    assert rows[1].listed is None and len(rows[1].bitmap) == 4096
    assert rows[2].listed == [0, 1, 2, 3] and rows[2].bitmap is None
    with pytest.raises(ValueError, match="no whole number"):
        distinct_sketches(df.select(F.col("id").cast("string").alias("s")), [], "s")
    assert distinct_rollup(distinct_sketches(df.limit(0), ["k"], "id"), ["k"]).count() == 0


def test_rollup_reads_sketches_only(spark, tmp_path):
    source = SnapshotTable(spark, str(tmp_path / "trips"), "t")
    append(source, spark.createDataFrame([(k % 7, "x", day(1 + k % 20)) for k in range(200)], ROWS))
    sketches = SnapshotTable(spark, str(tmp_path / "sketches"), "day")
    refresh_distinct(source, sketches, "2024-01-01", "2024-01-15", "k", ("v",))
    refresh_distinct(source, sketches, "2024-01-10", "2024-02-01", "k", ("v",))
    counted = distinct_rollup(sketches.read(), [F.trunc("day", "month").alias("month"), "v"])
    assert values(counted) == [(dt.date(2024, 1, 1), "x", 7)]
    assert counted.inputFiles() and all("/sketches/" in f for f in counted.inputFiles())
    # A day that is computed again replaces its sketches.
    replace(source, source.read().filter("k > 2"))
    refresh_distinct(source, sketches, "2024-01-01", "2024-02-01", "k", ("v",))
    assert values(distinct_rollup(sketches.read(), ["v"])) == [("x", 4)]


# -- sessions ---------------------------------------------------------------------------

EVENTS = "event_timestamp timestamp, PULocationID int"


def events(spark, rows):
    return spark.createDataFrame([(at_minute(m), k) for m, k in rows], EVENTS)


def at_minute(m):
    return None if m is None else DAY + dt.timedelta(minutes=m)


def sessions_of(rows):
    """Plain computation: (start, end, key, count)."""
    found = []
    for key in {k for _, k in rows if k is not None}:
        times = sorted(m for m, k in rows if k == key and m is not None)
        for i, m in enumerate(times):
            if i and m - times[i - 1] <= 5:
                found[-1] = (found[-1][0], m + 5, key, found[-1][3] + 1)
            else:
                found.append((m, m + 5, key, 1))
    return sorted(((at_minute(a), at_minute(b), k, n) for a, b, k, n in found), key=repr)


minutes = st.tuples(st.one_of(st.none(), st.integers(0, 3_000)), st.one_of(st.none(), st.integers(1, 2)))
near = st.tuples(st.integers(1_400, 1_480), st.just(1))


@FEW
@given(st.lists(st.lists(st.one_of(minutes, near), max_size=12), min_size=1, max_size=4))
def test_sessions_of_any_batches(spark, tmp_path_factory, batches):
    table = SnapshotTable(spark, str(tmp_path_factory.mktemp("s") / "t"), "session_end")
    for n, rows in enumerate(batches):
        merge_sessions(table, events(spark, rows), batch=("c", n))
        merge_sessions(table, events(spark, rows), batch=("c", n))  # repeated after a failure
    wanted = sessions_of([r for rows in batches for r in rows])
    assert (values(table.read()) if table.exists() else []) == wanted


def test_a_row_joins_two_sessions_and_the_rest_stays_unread(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), "session_end")
    merge_sessions(table, events(spark, [(0, 1), (10, 1), (0, 2), (2_000, 1), (1_435, 3), (1_441, 3)]))
    before = table.manifest().folders
    merge_sessions(table, events(spark, [(5, 1)]))
    assert values(table.read()) == sessions_of([(0, 1), (5, 1), (10, 1), (0, 2), (2_000, 1), (1_435, 3), (1_441, 3)])
    after = table.manifest().folders
    # The day after is not rewritten; a session that ends before the new rows is not read.
    assert after["part_from=2025-10-02"] == before["part_from=2025-10-02"]
    assert "InMemoryFileIndex(1 paths)" in plan(table.read_between(at_minute(1_450)))
    merge_sessions(table, events(spark, [(1_438, 3)]))  # across midnight: the end moves the row to another day
    assert (at_minute(1_435), at_minute(1_446), 3, 3) in values(table.read())
    with pytest.raises(ValueError, match="session_end"):
        merge_sessions(SnapshotTable(spark, str(tmp_path / "u"), "session_start"), events(spark, []))


def test_open_sessions_of_a_stream(spark, tmp_path):
    feed = Feed(tmp_path / "feed")
    table = SnapshotTable(spark, str(tmp_path / "t"), "session_end")
    sent = []
    for rows in ([("00:01:00", 7, 1.0), ("00:30:00", 7, 1.0)], [("00:04:00", 7, 1.0), ("00:31:00", None, 1.0)], [("00:08:00", 7, 1.0), ("23:59:00", 8, 1.0)]):
        feed.add(*rows)
        sent += rows
        stream = trip_events(read_trip_stream(spark, feed.folder, GREEN_TRIP, per_trigger=1))
        session_sink(stream, table, str(tmp_path / "c")).awaitTermination()
        batch = trip_events(spark.createDataFrame([(t, z) for t, z, _ in [(str(at(t)), z, a) for t, z, a in sent]], "lpep_pickup_datetime string, PULocationID int"))
        assert values(table.read()) == values(session_count(batch))
    assert len(table.manifest().applied) == 1


# -- late rows ----------------------------------------------------------------------------


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    feed = Feed(tmp_path / "feed")
    counts = CorrectedCounts(spark, str(tmp_path / "t"))
    deliveries = [
        [("00:01:00", 1, 1.0), ("00:02:00", None, 1.0), ("00:20:00", 1, 1.0)],
        [("00:03:00", 1, 1.0), ("00:16:00", 2, 1.0), ("00:14:59", 2, 1.0)],  # only windows that have ended are late
        [("00:03:00", 1, 2.0), ("00:40:00", 1, 1.0), ("00:01:00", None, 1.0)],
        [],
    ]
    for rows in deliveries:
        feed.add(*rows)
        stream = trip_events(read_trip_stream(spark, feed.folder, GREEN_TRIP, per_trigger=1))
        counts.sink(stream, str(tmp_path / "c")).awaitTermination()
    assert values(counts.late.read(), "event_timestamp", "PULocationID", "tip_amount", "batch_no") == [
        (at("00:14:59"), 2, 1.0, 1),
        (at("00:03:00"), 1, 1.0, 1),
        (at("00:03:00"), 1, 2.0, 2),
    ]
    assert values(counts.counts.read()) == [
        (at("00:00:00"), 1, 3, 2),
        (at("00:10:00"), 2, 1, 1),
        (at("00:15:00"), 2, 1, 0),
        (at("00:20:00"), 1, 1, 0),
        (at("00:40:00"), 1, 1, 0),
    ]
    assert counts.watermark() == at("00:39:55") and counts.closed().count() == 4
    every = [r for rows in deliveries for r in rows]
    batch = trip_events(spark.createDataFrame([(str(at(t)), z) for t, z, _ in every], "lpep_pickup_datetime string, PULocationID int"))
    assert values(counts.counts.read(), "window_start", "PULocationID", "num_trips") == values(tumbling_count(batch))


def test_a_batch_repeated_after_a_failure(spark, tmp_path, monkeypatch):
    """The late rows and the progress are written before the counts: a crash between repeats none of them."""
    from tripmart.sinks import windows

    counts = CorrectedCounts(spark, str(tmp_path / "t"))
    first, second = events(spark, [(1, 1), (100, 1)]), events(spark, [(2, 1), (130, 1)])
    counts.add(first, ("c", 0))

    def broken(*args, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(windows, "merge", broken)
        with pytest.raises(RuntimeError, match="lost"):
            counts.add(second, ("c", 1))
    for _ in range(2):
        counts.add(second, ("c", 1))
    assert counts.late.read().count() == 1 and counts.progress.read().count() == 2
    assert values(counts.counts.read(), "num_trips", "late_trips") == [(1, 0), (1, 0), (2, 1)]


# -- repeats ------------------------------------------------------------------------------


def test_repeats_within_the_watermark(spark, tmp_path):
    feed = Feed(tmp_path / "feed")
    kept = SnapshotTable(spark, str(tmp_path / "t"))

    def send(*rows):
        feed.add(*rows)
        stream = trip_events(read_trip_stream(spark, feed.folder, GREEN_TRIP, per_trigger=1))
        append_sink(deduped(stream, ["PULocationID"], "10 minutes"), kept, str(tmp_path / "c")).awaitTermination()
        return sorted(values(kept.read(), "PULocationID", "tip_amount"), key=repr)

    assert [k for k, _ in send(("00:00:00", 1, 1.0), ("00:00:00", 1, 1.0), ("00:01:00", None, 1.0), ("00:02:00", None, 1.0))] == [1, None]
    assert send(("00:05:00", 1, 2.0), ("00:05:00", 2, 2.0)) == [(1, 1.0), (2, 2.0), (None, 1.0)]
    send(("01:00:00", 9, 3.0))
    # The watermark is at 00:50: key 1 is forgotten, and a row from before it is late.
    assert send(("00:55:00", 1, 4.0), ("00:10:00", 5, 4.0)) == [(1, 1.0), (1, 4.0), (2, 2.0), (9, 3.0), (None, 1.0)]
    with pytest.raises(ValueError, match="dedupe_first"):
        deduped(events(spark, []), ["PULocationID"])
