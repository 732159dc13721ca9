import datetime as dt
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tests.conftest import plan, values
from tripmart.tables import (
    SnapshotTable,
    append,
    as_table,
    as_view,
    create_keyed_table,
    create_table_ddl,
    delete_insert,
    merge,
    register_external,
    register_views,
    replace,
    time_interval,
)

SCHEMA = "k int, v string, t timestamp_ntz"


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture(params=["whole", "day", "month"])
def table(request, spark, root):
    if request.param == "whole":
        return SnapshotTable(spark, root)
    return SnapshotTable(spark, root, time="t", grain=request.param)


def test_replace_append_and_old_versions(spark, table):
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    replace(table, rows(spark, (1, "a", day(1)), (2, "b", None)))
    before = table.read()
    append(table, rows(spark, (1, "a", day(1))))
    assert values(table.read()) == [(1, "a", day(1)), (1, "a", day(1)), (2, "b", None)]
    replace(table, rows(spark, (9, "z", day(3))))
    assert values(table.read()) == [(9, "z", day(3))]
    # A reader of the old version is not disturbed by a replacement.
    assert values(before) == [(1, "a", day(1)), (2, "b", None)]


def test_merge(spark, table):
    source = rows(spark, (2, "new", day(2)), (4, "d", day(9)), (None, "n", day(1)))
    merge(table, rows(spark, (1, "a", day(1)), (2, "b", day(1)), (3, "c", None)), ["k"])  # first run
    merge(table, source, ["k"])
    expected = [(1, "a", day(1)), (2, "new", day(2)), (3, "c", None), (4, "d", day(9)), (None, "n", day(1))]
    assert values(table.read()) == expected
    merge(table, source.dropna(subset=["k"]), ["k"])  # the same again changes nothing
    assert values(table.read()) == expected
    version = table.manifest().version
    merge(table, source.limit(0), ["k"])
    assert values(table.read()) == expected
    assert table.time is None or table.manifest().version == version


def test_merge_fails_on_duplicate_source_key(spark, table):
    replace(table, rows(spark, (1, "a", day(1))))
    with pytest.raises(ValueError, match="more than once"):
        merge(table, rows(spark, (1, "x", day(1)), (1, "y", day(2))), ["k"])
    assert values(table.read()) == [(1, "a", day(1))]


def test_merge_rewrites_only_days_with_known_keys(spark, root):
    table = SnapshotTable(spark, root, time="t")
    replace(table, rows(spark, *[(n, "a", day(n)) for n in range(1, 9)]))
    before = table.manifest().folders
    merge(table, rows(spark, (3, "x", day(3)), (99, "new", day(4))), ["k"])
    after = table.manifest().folders
    changed = {p for p in after if after[p] != before.get(p)}
    assert changed == {"part_from=2024-01-03", "part_from=2024-01-04"}
    assert set(before["part_from=2024-01-04"]) < set(after["part_from=2024-01-04"])
    assert not set(before["part_from=2024-01-03"]) & set(after["part_from=2024-01-03"])
    # A key that moves to another day leaves the old one.
    merge(table, rows(spark, (5, "moved", day(20))), ["k"])
    assert values(table.read().filter("k = 5")) == [(5, "moved", day(20))]


def test_key_with_the_time_looks_at_its_own_day_only(spark, root):
    table = SnapshotTable(spark, root, time="t")
    replace(table, rows(spark, *[(n, "a", day(n)) for n in range(1, 4)]))
    folder = table.manifest().folders["part_from=2024-01-02"][0]
    for name in os.listdir(f"{root}/data/{folder}"):
        with open(f"{root}/data/{folder}/{name}", "wb") as file:
            file.write(b"broken")
    merge(table, rows(spark, (3, "b", day(3)), (9, "new", day(3))), ["k", "t"])
    assert values(table.read(["part_from=2024-01-03"]), "k", "v") == [(3, "b"), (9, "new")]


def test_widening(spark, table):
    replace(table, rows(spark, (1, "a", day(1)), (2, "b", day(1))))
    wider = rows(spark, (2, "c", day(1))).withColumn("x", F.lit(7))
    with pytest.raises(ValueError, match="not in the table"):
        merge(table, wider, ["k"])
    merge(table, wider, ["k"], widen=True)
    assert values(table.read()) == [(1, "a", day(1), None), (2, "c", day(1), 7)]
    append(table, rows(spark, (3, "d", day(1))))  # a narrower source is filled with NULL
    assert values(table.read(), "k", "x") == [(1, None), (2, 7), (3, None)]
    with pytest.raises(ValueError, match="change their type"):
        append(table, spark.createDataFrame([("1", "a", day(1))], "k string, v string, t timestamp_ntz"))


def test_delete_insert_keeps_duplicates_of_the_source(spark, table):
    replace(table, rows(spark, (1, "a", day(1)), (1, "b", day(2)), (2, "c", day(1)), (None, "n", day(1))))
    delete_insert(table, rows(spark, (1, "x", day(5)), (1, "y", day(1))), ["k"])
    assert values(table.read()) == [
        (1, "x", day(5)), (1, "y", day(1)), (2, "c", day(1)), (None, "n", day(1)),
    ]


def test_time_interval(spark, table):
    replace(table, rows(spark, *[(n, "a", day(n, 6)) for n in range(1, 8)], (0, "none", None)))
    new = rows(spark, (3, "b", day(3, 6)), (30, "b", day(3, 7)))
    for _ in range(2):  # twice is as once
        time_interval(table, new, "t", "2024-01-03", "2024-01-05 06:00:00")
        # Day 4 becomes empty; the row at the end bound stays.
        assert values(table.read(), "k", "v") == [
            (0, "none"), (1, "a"), (2, "a"), (3, "b"), (30, "b"), (5, "a"), (6, "a"), (7, "a"),
        ]
    with pytest.raises(ValueError, match="outside"):
        time_interval(table, rows(spark, (1, "x", day(5, 6))), "t", "2024-01-03", "2024-01-05 06:00:00")
    with pytest.raises(ValueError, match="outside"):
        time_interval(table, rows(spark, (1, "x", None)), "t", "2024-01-03", "2024-01-05")
    time_interval(table, new.limit(0), "t", "2024-01-01", "2024-02-01")
    assert values(table.read(), "k") == [(0,)]


def test_time_interval_drops_whole_days_unread(spark, root):
    table = SnapshotTable(spark, root, time="t")
    replace(table, rows(spark, *[(n, "a", day(n)) for n in range(1, 6)]))
    folder = table.manifest().folders["part_from=2024-01-02"][0]
    for name in os.listdir(f"{root}/data/{folder}"):
        with open(f"{root}/data/{folder}/{name}", "wb") as file:
            file.write(b"broken")
    time_interval(table, rows(spark, (20, "b", day(2))), "t", "2024-01-02", "2024-01-03")
    assert values(table.read(), "k") == [(1,), (20,), (3,), (4,), (5,)]


def test_report_dates_as_interval_key(spark, root):
    table = SnapshotTable(spark, root, time="report_date")
    daily = spark.createDataFrame(
        [(dt.date(2024, 1, n), n) for n in range(1, 5)], "report_date date, trips int"
    )
    replace(table, daily)
    time_interval(table, daily.filter("trips = 2").withColumn("trips", F.lit(20)), "report_date", "2024-01-02", "2024-01-04")
    assert values(table.read(), "trips") == [(1,), (20,), (4,)]


def test_repeated_batch_is_ignored(spark, table):
    merge(table, rows(spark, (1, "a", day(1))), ["k"], batch=("s", 0))
    append(table, rows(spark, (2, "b", day(1))), batch=("s", 1))
    append(table, rows(spark, (2, "b", day(1))), batch=("s", 1))
    merge(table, rows(spark, (1, "old", day(1))), ["k"], batch=("s", 0))
    merge(table, rows(spark, (3, "c", day(1))), ["k"], batch=("other", 0))
    assert values(table.read(), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_crash_before_publishing_leaves_the_old_version(spark, table, monkeypatch):
    replace(table, rows(spark, (1, "a", day(1))))
    monkeypatch.setattr(SnapshotTable, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge(table, rows(spark, (1, "b", day(1))), ["k"])
    monkeypatch.undo()
    assert values(table.read()) == [(1, "a", day(1))]
    merge(table, rows(spark, (1, "b", day(1))), ["k"])
    assert values(table.read()) == [(1, "b", day(1))]


def test_second_writer_is_refused(spark, table):
    replace(table, rows(spark, (1, "a", day(1))))
    stale = table.manifest()
    append(table, rows(spark, (2, "b", day(1))))
    with pytest.raises(RuntimeError, match="another writer"):
        table.publish(type(stale)(stale.version + 1, stale.schema, stale.folders))


def test_expire_keeps_what_is_named(spark, table):
    for n in range(4):
        replace(table, rows(spark, (n, "a", day(1))))
    assert table.expire(keep=2) == 2
    assert values(table.read(), "k") == [(3,)]
    assert len(os.listdir(f"{table.root}/data")) == 2


def test_reserved_names_are_refused(spark, table):
    with pytest.raises(ValueError, match="part_from"):
        replace(table, rows(spark, (1, "a", day(1))).withColumn("part_from", F.lit(1)))


def test_keyed_table(spark, root):
    schema = T._parse_datatype_string(SCHEMA)
    table = create_keyed_table(spark, root, schema, ["k"], time="t")
    assert table.read().count() == 0 and table.read().schema == schema
    merge(table, rows(spark, (1, "a", day(1))))
    merge(table, rows(spark, (1, "b", day(1))))
    again = create_keyed_table(spark, root, schema, ["k"], time="t")
    assert values(again.read(), "v") == [("b",)]
    assert create_table_ddl(schema, "t", ("k",)).splitlines()[1:] == [
        "  `k` INT,", "  `v` STRING,", "  `t` TIMESTAMP_NTZ,", "  PRIMARY KEY (`k`)", ")",
    ]
    spark.sql(create_table_ddl(schema, "made_by_ddl") + " USING parquet")
    assert spark.table("made_by_ddl").schema == schema
    spark.sql("DROP TABLE made_by_ddl")


def test_hot_day_is_written_by_several_tasks(spark, root):
    table = SnapshotTable(spark, root, time="t")
    hot = spark.range(0, 300_000, 1, 8).selectExpr(
        "CAST(id AS INT) AS k", "uuid() AS v",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(CASE WHEN id % 3 = 0 THEN 0 ELSE CAST(id % 20 AS INT) END) AS t",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        replace(table, hot)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {
        p: [f for f in os.listdir(f"{root}/data/{folder[0]}") if f.endswith(".parquet")]
        for p, folder in table.manifest().folders.items()
    }
    assert len(files) == 20 and table.read().count() == 300_000
    counts = sorted(len(f) for f in files.values())
    assert len(files["part_from=2024-01-01"]) > 4 and counts[0] == 1
    assert sum(counts) < 20 * 8  # a folder does not get a file from every task


OPERATION = st.tuples(
    st.sampled_from(["merge", "delete_insert", "append"]),
    st.lists(st.tuples(st.integers(0, 6), st.integers(1, 4)), max_size=4),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(OPERATION, min_size=1, max_size=4))
def test_strategies_against_a_list(spark, tmp_path_factory, operations):
    table = SnapshotTable(spark, str(tmp_path_factory.mktemp("law") / "t"), time="t")
    replace(table, rows(spark, (0, "first", day(1))))
    model = [(0, "first", day(1))]
    for number, (name, pairs) in enumerate(operations):
        if name == "merge":
            pairs = list(dict(pairs).items())
        new = [(k, f"{name}{number}", day(d)) for k, d in pairs]
        if name != "append":
            model = [r for r in model if r[0] not in {k for k, _ in pairs}]
        model += new
        source = rows(spark, *new)
        if name == "append":
            append(table, source)
        else:
            {"merge": merge, "delete_insert": delete_insert}[name](table, source, ["k"])
    assert values(table.read()) == sorted(model, key=repr)


def test_views_and_catalog_tables(spark, tmp_path):
    df = rows(spark, (1, "a", day(1)))
    register_views({"v1": df})
    as_view(df, "shared_v", shared=True)
    assert spark.table("v1").count() == spark.table("global_temp.shared_v").count() == 1
    as_table(df, "kept")
    assert values(as_table(df.withColumn("k", F.lit(5)), "kept"), "k") == [(5,)]
    spark.sql("DROP TABLE kept")
    path = str(tmp_path / "outside")
    df.write.parquet(path)
    assert values(register_external(spark, "outside", path), "k") == [(1,)]
    spark.sql("DROP TABLE outside")
    assert os.path.exists(path)


def test_manifest_is_plain_json(spark, table):
    replace(table, rows(spark, (1, "é", day(1))))
    name = os.listdir(f"{table.root}/manifest")
    with open(f"{table.root}/manifest/{[n for n in name if n.endswith('.json') and n[0] != '.'][0]}") as file:
        assert json.load(file)["version"] == 1


def test_partitioned_external_table(spark, tmp_path):
    path = str(tmp_path / "external")
    rows(spark, (1, "a", day(1)), (2, "b", day(1)), (3, "b", None)).write.partitionBy("v").parquet(path)
    found = register_external(spark, "external_by_v", path)
    assert values(found, "k", "v") == [(1, "a"), (2, "b"), (3, "b")]
    assert "PartitionFilters: [isnotnull(v" in plan(found.filter("v = 'a'"))


def test_append_packs_crowded_partitions(spark, table, monkeypatch):
    from tripmart.tables import strategies

    monkeypatch.setattr(strategies, "MAX_FOLDERS_PER_PARTITION", 3)
    for k in range(11):
        append(table, rows(spark, (k, "a", day(1)), (k, "b", day(1 + k % 2))))
    assert sorted(r.k for r in table.read().collect()) == sorted(2 * list(range(11)))
    assert all(len(folders) <= 4 for folders in table.manifest().folders.values())


def test_merge_bounds_the_search_by_key(spark, root):
    from tripmart.tables.strategies import _within_bounds

    target = SnapshotTable(spark, root, time="t")
    replace(target, spark.range(100).selectExpr("cast(id as int) AS k", "'a' AS v", "TIMESTAMP_NTZ '2024-01-01' AS t"))
    new = rows(spark, (7, "new", day(2)), (9, "new", day(2)), (200, "new", day(2)))
    assert "GreaterThanOrEqual(k,7)" in plan(target.read().filter(_within_bounds(new, ["k"])))
    merge(target, new, ["k"])
    assert target.read().count() == 101
    assert values(target.read().filter("v = 'new'"), "k") == [(200,), (7,), (9,)]
