import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, values
from tripmart.operators import (
    between_dates_inclusive,
    concat_all,
    conditional_count,
    count_by,
    count_distinct,
    count_non_null,
    date_span,
    dedupe_first,
    dev_sample,
    distinct_rows,
    having_count,
    head,
    high_water,
    in_interval,
    join_zone,
    least_frequent,
    left_lookup,
    longest_trips,
    matched,
    new_rows_only,
    on_date,
    orphans,
    rank_ascending,
    require_not_null,
    row_count,
    share_of,
    top_windows,
    total,
    union_aligned,
    unmatched,
)
from tripmart.schemas import ZONES, payment_lookup


def at(*parts):
    return dt.datetime(*parts)


@pytest.fixture
def stamps(spark):
    rows = [(1, at(2024, 1, 1)), (2, at(2024, 1, 1, 23, 59, 59)), (3, at(2024, 1, 2)), (4, None),
            (5, at(2024, 1, 3))]
    return spark.createDataFrame(rows, "id int, t timestamp_ntz")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_intervals(stamps):
    assert ids(stamps.filter(in_interval("t", "2024-01-01", "2024-01-02"))) == [1, 2]
    assert ids(stamps.filter(on_date("t", "2024-01-01"))) == [1, 2]
    assert ids(stamps.filter(between_dates_inclusive("t", "2024-01-01", "2024-01-02"))) == [1, 2, 3]
    assert ids(dev_sample(stamps, True, "2024-01-02", "2024-01-03", "t")) == [3]
    assert ids(dev_sample(stamps, False, "2024-01-02", "2024-01-03", "t")) == [1, 2, 3, 4, 5]
    assert ids(require_not_null(stamps, "t", "id")) == [1, 2, 3, 5]


def test_filters_reach_the_reader(spark, stamps, tmp_path):
    path = str(tmp_path / "stamps")
    stamps.write.parquet(path)
    stored = spark.read.parquet(path).select("t", "id")
    for condition in (
        in_interval("t", "2024-01-01", "2024-01-02"),
        on_date("t", "2024-01-01"),
        between_dates_inclusive("t", "2024-01-01", "2024-01-02"),
    ):
        text = plan(stored.filter(condition))
        assert "GreaterThanOrEqual(t" in text and "LessThan(t" in text


def test_new_rows_only(spark, stamps):
    target = stamps.filter("id = 2")
    assert ids(new_rows_only(stamps, target, "t")) == [3, 5]
    # The bound is strict; a lookback brings late rows and equal ones back.
    assert ids(new_rows_only(stamps, target, "t", lookback="1 day")) == [1, 2, 3, 5]
    assert ids(new_rows_only(stamps, target.limit(0), "t")) == [1, 2, 3, 4, 5]


def test_zone_join_drops_and_lookup_keeps_unmatched(spark):
    trips = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, PULocationID int")
    zones = spark.createDataFrame([(10, "Queens", "Jamaica Bay", "Boro Zone")], ZONES)
    assert values(join_zone(trips, zones), "id", "Zone") == [(1, "Jamaica Bay")]
    found = left_lookup(trips, zones, "PULocationID", "LocationID", {"zone": "Zone"})
    assert values(found, "id", "zone") == [(1, "Jamaica Bay"), (2, None), (3, None)]


def test_lookup_is_broadcast_only_while_small(spark):
    trips = spark.range(10).withColumnRenamed("id", "payment_type")
    lookup = payment_lookup(spark)
    small = left_lookup(trips, lookup, "payment_type", "payment_type", {"d": "description"})
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = left_lookup(trips, lookup, "payment_type", "payment_type", {"d": "description"}, limit=0)
        assert "SortMergeJoin" in plan(large)
        assert values(large) == values(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_of_a_shuffled_lookup_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 400_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "uuid() AS pad"
        )
        lookup = spark.range(0, 400_000, 1, 8).selectExpr("id AS key", "id * 2 AS twice")
        joined = left_lookup(rows, lookup, "k", "key", {"twice": "twice"}, limit=0)
        joined.write.format("noop").mode("overwrite").save()
        checked = joined.agg(F.count("*"), F.count_if(F.col("twice") != F.col("k") * 2)).first()
        assert tuple(checked) == (400_000, 0)
        frame = joined.select("k", "twice", "pad")
        frame.collect()
        assert "SortMergeJoin(skew=true)" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_existence_joins(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert values(matched(left, right, ["k"])) == [(1,)]
    assert values(unmatched(left, right, ["k"])) == [(2,), (None,)]


def test_orphans_counts_rows_per_lost_key(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert values(orphans(child, "fk", parent, "pk")) == [(9, 2)]
    assert values(orphans(child, "fk", parent.limit(0), "pk")) == [(1, 1), (9, 2)]


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 1.0, at(2024, 1, 1)), ("a", None, at(2024, 1, 3)), ("b", 9.0, None)],
        "k string, x double, t timestamp_ntz",
    )
    assert values(row_count(df)) == [(3,)]
    assert values(count_by(df, "k")) == [("a", 2), ("b", 1)]
    assert values(having_count(count_by(df, "k"), "n", 1)) == [("b", 1)]
    assert values(date_span(df, "t")) == [(at(2024, 1, 1), at(2024, 1, 3))]
    assert values(conditional_count(df, F.col("x") > 5)) == [(3, 1)]
    row = df.agg(total("x"), count_non_null("x"), count_distinct("k"), share_of(F.col("x") > 5)).first()
    assert tuple(row) == (10.0, 2, 2, 1 / 3)
    assert high_water(df, "t") == at(2024, 1, 3)
    assert high_water(df.limit(0), "t") is None


def test_dedupe_total_order_and_nulls(spark):
    rows = [
        ("a", 1, at(2024, 1, 2), 5),
        ("a", 1, at(2024, 1, 1), 9),
        ("a", 1, at(2024, 1, 1), 3),  # equal order value: the smaller rest wins
        ("b", None, None, 1),  # NULL key part is a group, NULL order value is first
        ("b", None, at(2024, 1, 1), 0),
    ]
    df = spark.createDataFrame(rows, "k string, v int, t timestamp_ntz, rest int")
    expected = [("a", 1, at(2024, 1, 1), 3), ("b", None, None, 1)]
    for parts in (1, 3):
        assert values(dedupe_first(df.repartition(parts), ["k", "v"], ["t"])) == expected
    assert plan(dedupe_first(df, ["k", "v"], ["t"])).count("WindowGroupLimit") == 2


def test_dedupe_sends_one_row_per_key_and_task(spark):
    # A third of the rows has one key: what is shuffled is bounded by the tasks.
    df = spark.range(0, 90_000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS t"
    )
    first = dedupe_first(df, ["k"], ["t"])
    first.collect()
    text = first._jdf.queryExecution().executedPlan().toString()
    assert text.index("Window [row_number") < text.index("Exchange hashpartitioning")
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle
    assert first.count() == 60_001


def test_rankings(spark):
    counts = spark.createDataFrame([("b", 1), ("a", 1), ("c", 7)], "zone string, n int")
    assert [r["zone"] for r in rank_ascending(counts, "n", "zone", 2).collect()] == ["a", "b"]
    assert [r["zone"] for r in least_frequent(counts, "n", "zone").collect()] == ["a"]
    assert [r["zone"] for r in top_windows(counts, "n", 2, ["zone"]).collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan(top_windows(counts, "n", 2))
    assert head(counts, 2).count() == 2
    trips = spark.createDataFrame(
        [(at(2024, 1, 1), at(2024, 1, 2)), (at(2024, 1, 1), None), (at(2024, 1, 1), at(2024, 1, 1, 1))],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz",
    )
    assert [r["trip_hours"] for r in longest_trips(trips, 5).collect()] == [24.0, 1.0, None]


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2, 0.5)], "s string, i int, d double")
    assert values(union_aligned([a, b], ["i", "s"])) == [(1, "x"), (2, "y")]
    assert values(concat_all(spark, [a, b], b.schema), "i", "s", "d") == [(1, "x", None), (2, "y", 0.5)]
    none = concat_all(spark, [], a.schema)
    assert none.count() == 0 and none.schema == a.schema
    assert values(distinct_rows(a.union(a), "i")) == [(1,)]
