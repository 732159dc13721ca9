import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan, values
from tripmart.quality import not_null, unique
from tripmart.registry import messages, storage
from tripmart.schemas import INGESTED, YELLOW_RAW, ZONES
from tripmart.sinks import write_day, write_layout, write_pages, write_parquet, write_partitioned
from tripmart.sinks.files import PAGE_ROWS, write_bucketed
from tripmart.sources import (
    count_from_footers,
    child_tables,
    explode_children,
    flatten_structs,
    load_seed,
    month_range,
    paged,
    read_csv_inferred,
    read_csv_typed,
    read_months,
    read_paged,
    read_parquet,
)
from tripmart.sources.streams import kafka_options
from tripmart.sources.jdbc import KeyRange, read_options, write_options

ZONE_CSV = '''"LocationID","Borough","Zone","service_zone"
1,"EWR","Newark Airport","EWR"
264,"Unknown","NV","N/A"
265,"Unknown","NA","N/A"
266,"","Empty",""
'''


@pytest.fixture
def zone_file(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(ZONE_CSV)
    return str(path)


def test_csv_null_texts(spark, zone_file):
    kept = read_csv_typed(spark, zone_file, schema=ZONES)
    assert values(kept.filter("LocationID > 263"), "Borough", "Zone", "service_zone") == [
        ("Unknown", "NA", "N/A"), ("Unknown", "NV", "N/A"), (None, "Empty", None),
    ]
    as_null = read_csv_typed(spark, zone_file, schema=ZONES, null_tokens=["NA", "N/A"])
    assert values(as_null.filter("LocationID = 265"), "Zone", "service_zone") == [(None, None)]
    assert read_csv_inferred(spark, zone_file).schema["LocationID"].dataType == T.IntegerType()


def test_seed_is_checked(spark, zone_file, tmp_path):
    assert load_seed(spark, zone_file, ZONES, [not_null("LocationID"), unique("LocationID")]).count() == 4
    with pytest.raises(Exception, match="unique"):
        load_seed(spark, zone_file, ZONES, [unique("Borough"), unique("service_zone")])


def test_gzip_csv_loads_every_row(spark, tmp_path):
    path = str(tmp_path / "trips.csv.gz")
    header = ",".join(YELLOW_RAW.names)
    line = "1,2021-01-01 00:30:10,2021-01-01 00:36:12,1,2.1,1,N,142,43,2,8,3,.5,0,0,.3,11.8,2.5"
    empty = ",2021-01-01 00:30:10,,,,,,,,,,,,,,,,"
    with gzip.open(path, "wt") as file:
        file.write("\n".join([header, *[line] * 1000, empty]))
    df = read_csv_typed(spark, path, schema=YELLOW_RAW, partitions=4)
    assert df.count() == 1001 and df.columns == YELLOW_RAW.names
    assert values(df.filter("VendorID IS NULL"), "tpep_pickup_datetime", "fare_amount") == [
        (dt.datetime(2021, 1, 1, 0, 30, 10), None)
    ]


def test_bad_csv_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\nx,a,b,c\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv_typed(spark, str(path), schema=ZONES).collect()


def test_parquet_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    write_parquet(spark.range(100).selectExpr("id", "id AS other"), path, n_files=4)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4
    assert "ReadSchema: struct<id:bigint>" in plan(read_parquet(spark, path, columns=["id"]))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_parquet(spark.range(1), path)
    write_parquet(spark.range(1), path, mode="overwrite")
    assert read_parquet(spark, path).count() == 1


def test_count_from_footers(spark, tmp_path):
    path = str(tmp_path / "rows")
    write_parquet(spark.range(1000), path, n_files=3)
    counted = count_from_footers(spark, path)
    assert "PushedAggregation: [COUNT(*)]" in plan(counted) and values(counted) == [(1000,)]
    # The caller's session is left as it was.
    assert "PushedAggregation" not in plan(spark.read.parquet(path).agg(F.count("*")))


def test_months():
    assert month_range("2024-11-15", "2025-02-15") == ["2024-11", "2024-12", "2025-01"]
    assert month_range("2024-11-15", "2025-02-16") == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert month_range("2024-01-31", "2024-03-01") == ["2024-01", "2024-02"]
    assert month_range("2024-01-01", "2024-01-01") == []


def test_read_months_across_schemas(spark, tmp_path):
    names = [f.name for f in YELLOW_RAW.fields]
    base = {n: None for n in names} | {"VendorID": 1, "passenger_count": 2, "total_amount": 5.0}
    row = tuple(base[n] for n in names)
    first = spark.createDataFrame([row], YELLOW_RAW)
    second = first.withColumn("passenger_count", F.lit(3.0)).withColumn("VendorID", F.lit(2).cast("int"))
    first.write.parquet(str(tmp_path / "yellow_tripdata_2024-01.parquet"))
    second.write.parquet(str(tmp_path / "yellow_tripdata_2024-02.parquet"))
    with pytest.raises(FileNotFoundError, match="2024-03"):
        read_months(spark, str(tmp_path), "2024-01-01", "2024-04-01", ["yellow"])
    trips = read_months(spark, str(tmp_path), "2024-01-01", "2024-04-01", on_missing="skip")
    assert trips.columns == INGESTED.names
    assert values(trips, "vendor_id", "passenger_count", "taxi_type") == [(1, 2.0, "yellow"), (2, 3.0, "yellow")]
    assert trips.filter("extracted_at IS NULL").count() == 0
    assert "congestion_surcharge" not in plan(trips)
    assert read_months(spark, str(tmp_path), "2030-01-01", "2030-02-01", on_missing="skip").count() == 0


def test_jdbc_options():
    split = KeyRange("id", 1, 1000, 8)
    assert read_options("jdbc:x", "SELECT * FROM genome LIMIT 1000", 100, split, user="u") == {
        "url": "jdbc:x", "fetchsize": "100", "dbtable": "(SELECT * FROM genome LIMIT 1000) q", "user": "u",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "8",
    }
    assert read_options("jdbc:x", "genome")["dbtable"] == "genome"
    assert write_options("jdbc:x", "t")["batchsize"] == "2000"


def test_kafka_options():
    assert kafka_options("host:9092", "green-trips", 500, {"kafka.group.id": "hourly"}) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "green-trips", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500", "kafka.group.id": "hourly",
    }


def test_nested_documents(spark, tmp_path):
    path = tmp_path / "docs.json"
    docs = [
        {"id": 1, "user": {"login": "a", "plan": {"name": "x"}}, "labels": [{"name": "p", "m": {"c": 1}}, {"name": "q", "m": None}]},
        {"id": 2, "user": None, "labels": []},
        {"id": 3, "user": {"login": "c"}, "labels": None},
    ]
    path.write_text("\n".join(json.dumps(d) for d in docs))
    df = spark.read.json(str(path))
    parent, child = explode_children(df, "labels", "id")
    assert values(parent, "id", "user__login", "user__plan__name") == [(1, "a", "x"), (2, None, None), (3, "c", None)]
    assert values(child, "id", "position", "name", "m__c") == [(1, 0, "p", 1), (1, 1, "q", None)]
    assert explode_children(df, "labels", "id", keep_empty=True)[1].count() == 4
    scalars = spark.createDataFrame([(1, [5, 6])], "id int, xs array<int>")
    assert values(explode_children(scalars, "xs", "id")[1]) == [(1, 0, 5), (1, 1, 6)]
    assert flatten_structs(scalars).columns == ["id", "xs"]


def test_arrays_at_any_depth(spark, tmp_path):
    docs = [
        {"id": 1, "a": {"xs": [{"id": 7, "ys": [[1, 2], [3]]}, {"id": 8, "ys": []}]}},
        {"id": 2, "a": {"xs": None}},
    ]
    (tmp_path / "docs.json").write_text("\n".join(json.dumps(d) for d in docs))
    tables = child_tables(spark.read.json(str(tmp_path / "docs.json")), ["id"])
    assert values(tables["root"]) == [(1,), (2,)]
    assert values(tables["root__a__xs"], "id", "a__xs__position", "a__xs__id") == [(1, 0, 7), (1, 1, 8)]
    assert values(tables["root__a__xs__ys__value"]) == [(1, 0, 0, 0, 1), (1, 0, 0, 1, 2), (1, 0, 1, 0, 3)]
    assert set(tables) == {"root", "root__a__xs", "root__a__xs__ys", "root__a__xs__ys__value"}


PAGE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


@pytest.mark.parametrize("n_pages", [0, 1, 2, 7, 16, 33])
def test_paged_numbers(spark, tmp_path, n_pages):
    for page in range(1, n_pages + 1):
        records = [{"id": page * 10 + i, "name": f"n{i}", "more": 1} for i in range(3)]
        (tmp_path / f"{page}.json").write_text(json.dumps(records))
    (tmp_path / f"{n_pages + 1}.json").write_text("[]")
    df = read_paged(spark, f"file://{tmp_path}/{{page}}.json", PAGE, pages_per_task=4)
    assert df.rdd.getNumPartitions() == max(1, -(-n_pages // 4))
    assert values(df, "id") == sorted([(p * 10 + i,) for p in range(1, n_pages + 1) for i in range(3)], key=repr)


def test_paged_keys(spark, tmp_path):
    (tmp_path / "magnus c.json").write_text(json.dumps({"id": 1, "name": "m"}))
    (tmp_path / "two.json").write_text('{"id": 2}\n{"id": 3}\n')
    df = read_paged(spark, f"file://{tmp_path}/{{key}}.json", PAGE, "keys", keys=["magnus c", "two"])
    assert values(df) == [(1, "m"), (2, None), (3, None)]


def test_missing_pages_fail_or_are_skipped(spark, tmp_path):
    for key in (1, 2, 3):
        (tmp_path / f"{key}.json").write_text(json.dumps({"id": key}))
    url = f"file://{tmp_path}/{{key}}.json"
    with pytest.raises(Exception, match="PageMissing"):
        read_paged(spark, url, PAGE, "keys", keys=["1", "2", "missing", "3"]).collect()
    some = read_paged(spark, url, PAGE, "keys", keys=["1", "2", "missing", "3"], on_missing="skip")
    assert values(some, "id") == [(1,), (2,), (3,)]
    # In number mode a missing page ends the search.
    assert values(read_paged(spark, f"file://{tmp_path}/{{page}}.json", PAGE), "id") == [(1,), (2,), (3,)]


def test_records_inside_an_object(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"data": {"items": [{"id": 1}, {"id": 2}]}, "n": 2}))
    url = f"file://{tmp_path}/{{page}}.json"
    assert values(read_paged(spark, url, PAGE, records_path="data.items"), "id") == [(1,), (2,)]
    for path in ("", "data", "items"):
        with pytest.raises(Exception, match="records_path|has no"):
            read_paged(spark, url, PAGE, records_path=path).collect()


def test_lines_of_a_page_are_parsed_one_by_one():
    records = paged.records_of('{"a": 1}\n\n{"a": "\u2028"}\r\n{"a": 3}\nno json')
    assert [next(records) for _ in range(3)] == [{"a": 1}, {"a": "\u2028"}, {"a": 3}]
    with pytest.raises(ValueError):
        next(records)
    for text, rows in (("", []), (" \n", []), ('{\n"a": 1}\n', [{"a": 1}]), ('[{"a": 1},\n{"a": 2}]', [{"a": 1}, {"a": 2}])):
        assert list(paged.records_of(text)) == rows
    for text, path in (("1", ""), ("null", ""), ("[1]", ""), ('{"a": 1}\n2', ""), ("[]\n[]", ""), ('{"a": []}\n{"a": []}', "a")):
        with pytest.raises(ValueError):
            list(paged.records_of(text, path))


def test_larger_tables_are_written_in_more_pages(spark, tmp_path):
    rows = spark.range(100).selectExpr("nullif(id, 3) AS id", "nullif(id % 2, 1) AS b")

    def pages(name, df, **options):
        names = write_pages(df, str(tmp_path / name), **options)
        assert all((tmp_path / name / n).is_file() for n in names)
        return [[json.loads(line) for line in (tmp_path / name / n).read_text().splitlines()] for n in names]

    for n_parts in (1, 3):
        found = pages(f"rows-{n_parts}", rows.repartition(n_parts), n_rows=7)
        assert max(map(len, found)) == 7 and all(set(r) == {"id", "b"} for p in found for r in p)
        assert sorted((repr(r["id"]), repr(r["b"])) for p in found for r in p) == sorted((repr(i), repr(b)) for i, b in rows.collect())
    assert len(pages("few", rows.coalesce(1))) >= 8
    # The first of Spark's tasks has no row here: its empty file would end the search for the last page.
    behind = spark.range(0, 100, 1, 4).filter("id >= 50")
    assert [len(p) for p in pages("behind", behind, n_rows=25, least=1)] == [25, 25]
    assert pages("none", rows.limit(0)) == []


@pytest.mark.parametrize(
    "query, column", [(storage.paged_source, "o_orderstatus"), (messages.paged_numbers, "o_totalprice")]
)
def test_pages_of_a_larger_table_are_as_long(spark, tmp_path, query, column):
    orders = spark.range(200_000).selectExpr(
        "id AS o_orderkey", "IF(id % 3 = 0, NULL, 'F') AS o_orderstatus", "id / 4 AS o_totalprice"
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    df = query(spark, str(tmp_path))
    most = df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 2 * PAGE_ROWS  # two pages a task
    assert df.count() == 200_000 and df.exceptAll(orders.select("o_orderkey", column)).isEmpty()


def test_pages_without_an_end():
    with pytest.raises(ValueError):
        paged.last_page(lambda n: True, 1)


def test_paged_links(monkeypatch):
    pages = {
        "http://x/?page=1": ([{"id": 1}], '<http://x/?page=2>; rel="next", <http://x/?page=3>; rel="last"'),
        "http://x/?page=2": ([{"id": 2}], '<http://x/?page=3>; rel="next", <http://x/?page=3>; rel="last"'),
        "http://x/?page=3": ([{"id": 3}], '<http://x/?page=1>; rel="first"'),
        "http://x/?cursor=a": ([{"id": 4}], '<http://x/?cursor=b>; rel="next"'),
        "http://x/?cursor=b": ([{"id": 5}], ""),
    }
    monkeypatch.setattr(paged, "fetch", lambda url, headers=None, records_path="": pages[url])

    def read(url):
        reader = paged.PagedReader(PAGE, {"url": url, "mode": "link", "pages_per_task": "2"})
        parts = reader.partitions()
        return len(parts), [r[0] for p in parts for r in reader.read(p)]

    assert read("http://x/?page=1") == (2, [1, 2, 3])
    assert read("http://x/?cursor=a") == (1, [4, 5])


def test_last_page_asks_few_times():
    for last in (*range(0, 20), 1000):
        asked = []

        def has_rows(n):
            asked.append(n)
            return n <= last

        assert paged.last_page(has_rows, 1) == last
        assert len(asked) <= 2 * last.bit_length() + 1


def test_write_day_replaces_one_day(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(1, 3), (2, 4)], "A int, B int")
    write_day(df, path, "2024-01-01")
    write_day(df, path, "2024-01-02")
    write_day(df.filter("A = 1"), path, "2024-01-01")
    assert values(spark.read.parquet(path), "day", "A") == [
        (dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 1), (dt.date(2024, 1, 2), 2),
    ]


def test_layout(spark, tmp_path):
    path = write_layout(spark.range(3), str(tmp_path), "rides_dataset", "rides", "json")
    assert path.endswith("rides_dataset/rides.json") and spark.read.json(path).count() == 3


def test_partitioned_and_clustered(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.range(0, 1000, 1, 8).selectExpr(
        "id % 7 AS vendor", "TIMESTAMP_NTZ'2024-03-01 00:00:00' + make_dt_interval(CAST(id % 20 AS INT)) AS dropped"
    )
    write_partitioned(df, path, "dropped", "vendor")
    stored = spark.read.parquet(path)
    wanted = stored.filter("dropped_day BETWEEN DATE'2024-03-01' AND DATE'2024-03-15'")
    assert "PartitionFilters: [isnotnull(dropped_day" in plan(wanted)
    folders = [d for d in os.listdir(path) if d.startswith("dropped_day=")]
    assert len(folders) == 20
    for folder in folders:
        files = [f for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet")]
        assert len(files) == 1
        order = [r[0] for r in spark.read.parquet(f"{path}/{folder}/{files[0]}").select("vendor").collect()]
        assert order == sorted(order)


def test_bucketed_join_needs_no_shuffle(spark):
    for name in ("left_b", "right_b"):
        write_bucketed(spark.range(1000).selectExpr("id AS k", "id AS v"), name, "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_b").join(spark.table("right_b"), "k")
        assert "Exchange" not in plan(joined) and joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE left_b")
        spark.sql("DROP TABLE right_b")
