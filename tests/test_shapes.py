"""Documents of unknown shape, growing types, interleaved order, parity by buckets, pages as a stream."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tests.conftest import plan, values
from tripmart.functions import decode_json, encode_json
from tripmart.quality import differing_buckets, parity, parity_in_buckets, scanned_partitions
from tripmart.registry import shapes
from tripmart.sinks import append_sink, interleaved, write_clustered
from tripmart.sinks.files import PAGE_ROWS
from tripmart.sources import explode_documents, field_kinds, parse_documents, read_documents, shape_of, split_kinds, stream_paged
from tripmart.tables import SnapshotTable, append, common_type, merge

# -- messages -------------------------------------------------------------------------


def test_a_message_is_parsed_once(spark):
    df = spark.range(3).select("id", F.lit("x").alias("a"), (F.col("id") * 2.5).alias("b"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    for how in ("fail", "divert", "null"):
        decoded = decode_json(encode_json(df), schema, on_bad=how)
        optimized = decoded._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("from_json(") == 1
    assert values(decode_json(encode_json(df), schema)) == values(df)


# -- documents ------------------------------------------------------------------------

DOCUMENTS = [
    {"k": 1, "a": 5, "tags": [1, "x", {"y": None}]},
    {"k": 2, "a": "five"},
    {"k": 3, "a": {"value": 5.25}, "tags": "none"},
    {"k": 4, "a": None, "tags": []},
    {"k": 5, "a": [1]},
    {"k": 6, "a": True},
    {"k": 7},
    {"k": 8, "a": 12345678901234567890123.5},
]


@pytest.fixture
def documents(spark, tmp_path):
    path = tmp_path / "docs.txt"
    path.write_text("\n".join(json.dumps(d) for d in DOCUMENTS))
    return read_documents(spark, str(path)).withColumn("k", F.variant_get("doc", "$.k", "int"))


def test_kinds_are_kept_apart(documents):
    apart = split_kinds(documents, "$.a", "a")
    found = {
        r.k: {n[3:]: r[n] if n in ("a__number", "a__text", "a__flag") else r[n].toPython() for n in apart.columns if n.startswith("a__") and r[n] is not None}
        for r in apart.collect()
    }
    assert found == {
        1: {"number": Decimal("5.000000000")},
        2: {"text": "five"},
        3: {"object": {"value": 5.25}},
        4: {},
        5: {"list": [1]},
        6: {"flag": True},
        7: {},
        8: {"number": found[8]["number"]},
    }
    assert float(found[8]["number"]) == DOCUMENTS[7]["a"]
    with pytest.raises(ValueError, match="no such kinds"):
        split_kinds(documents, "$.a", "a", ["date"])


def test_fields_and_shape(documents):
    assert values(field_kinds(documents)) == sorted(
        [("k", "number", 8), ("a", "number", 2), ("a", "text", 1), ("a", "object", 1), ("a", "null", 1), ("a", "list", 1), ("a", "flag", 1),
         ("tags", "list", 2), ("tags", "text", 1)],
        key=repr,
    )
    assert shape_of(documents).startswith("OBJECT<a: VARIANT, k: BIGINT")
    assert shape_of(documents.limit(0)) == "VOID"


def test_elements(documents):
    rows = explode_documents(documents, "$.tags", ["k"]).collect()
    assert [(r.k, r.position, r.doc.toPython()) for r in rows] == [(1, 0, 1), (1, 1, "x"), (1, 2, {"y": None})]


def test_bad_documents(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{"), (3, None)], "k int, value string")
    with pytest.raises(Exception, match="MALFORMED"):
        parse_documents(df).collect()
    rows = parse_documents(df, on_bad="null").collect()
    assert [r.doc and r.doc.toPython() for r in rows] == [{"a": 1}, None, None]
    with pytest.raises(ValueError):
        parse_documents(df, on_bad="drop")


# -- types -----------------------------------------------------------------------------

TYPES = {
    "byte": (T.ByteType(), 127),
    "short": (T.ShortType(), -32768),
    "int": (T.IntegerType(), 2**31 - 1),
    "long": (T.LongType(), 2**63 - 1),
    "float": (T.FloatType(), 0.5),
    "double": (T.DoubleType(), 1e300),
    "decimal": (T.DecimalType(10, 2), Decimal("12345678.25")),
    "longer": (T.DecimalType(14, 4), Decimal("1234567890.0625")),
    "date": (T.DateType(), dt.date(2024, 2, 29)),
    "stamp": (T.TimestampNTZType(), dt.datetime(2024, 2, 29, 1)),
    "text": (T.StringType(), "x"),
}


@pytest.mark.parametrize("old", TYPES)
def test_every_pair_of_types(spark, tmp_path, old):
    """Either both values come back exactly, or the change is refused and the table is as before."""
    for new in TYPES:
        (first, a), (second, b) = TYPES[old], TYPES[new]
        table = SnapshotTable(spark, str(tmp_path / new))
        append(table, spark.createDataFrame([(1, a)], T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", first)])))
        more = spark.createDataFrame([(2, b)], T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", second)]))
        wide = common_type(first, second)
        assert wide == common_type(second, first)
        if wide is None:
            with pytest.raises(ValueError, match="change their type"):
                append(table, more, widen=True)
            assert [r.v for r in table.read().collect()] == [a]
            continue
        if first != second:
            with pytest.raises(ValueError, match="change their type"):
                append(table, more)
        merge(table, more, ["k"], widen=True)
        found = {r.k: r.v for r in table.read().collect()}
        assert table.read().schema["v"].dataType == wide
        as_stamp = {k: dt.datetime(v.year, v.month, v.day) if wide == T.TimestampNTZType() and not isinstance(v, dt.datetime) else v for k, v in ((1, a), (2, b))}
        assert found == as_stamp


def test_steps_of_the_lattice():
    steps = {
        ("int", "long"): T.LongType(), ("long", "decimal"): T.DecimalType(22, 2), ("int", "float"): T.DoubleType(),
        ("float", "double"): T.DoubleType(), ("decimal", "longer"): T.DecimalType(14, 4), ("long", "double"): None,
        ("double", "decimal"): None, ("text", "int"): None, ("date", "stamp"): T.TimestampNTZType(), ("date", "long"): None,
    }
    for (a, b), wide in steps.items():
        assert common_type(TYPES[a][0], TYPES[b][0]) == wide
    assert common_type(T.DecimalType(38, 0), T.DecimalType(10, 9)) is None


# -- order ------------------------------------------------------------------------------


def scanned_rows(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan_run = df._jdf.queryExecution().executedPlan()
    leaves = plan_run.collectLeaves() if "Adaptive" not in plan_run.nodeName() else plan_run.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_filter_on_the_second_key_skips(spark, tmp_path):
    df = spark.range(40_000).select((F.xxhash64("id") % 1000).alias("a"), (F.xxhash64(F.col("id") + 7) % 1000).alias("b"), "id")
    both, one = str(tmp_path / "both"), str(tmp_path / "one")
    write_clustered(df, both, ["a", "b"], n_files=64)
    df.repartitionByRange(64, "a", "b").sortWithinPartitions("a", "b").write.parquet(one)
    for key in ("a", "b"):
        wanted = F.col(key).between(100, 120)
        found = spark.read.parquet(both).filter(wanted)
        assert values(found.select("id")) == values(df.filter(wanted).select("id"))
        assert scanned_rows(found) < 40_000 / 3
    assert scanned_rows(spark.read.parquet(one).filter(F.col("b").between(100, 120))) == 40_000


def test_interleaved_positions(spark):
    rows = [(i % 16, f"k{i // 16:02d}", dt.date(2024, 1, 1 + i % 28), None) for i in range(256)]
    df = spark.createDataFrame(rows, "a int, s string, d date, n double")
    placed = {(r.a, r.s): r.z for r in df.select("a", "s", interleaved(df, ["a", "s"], bits=4).alias("z")).collect()}
    assert len(set(placed.values())) == 256
    # A square of the grid is one stretch of the curve.
    assert max(z for (a, s), z in placed.items() if a < 8 and s < "k08") == 63
    assert {r.z for r in df.select(interleaved(df, ["n"], bits=4).alias("z")).collect()} == {0}
    assert df.select(interleaved(df, ["d", "a", "s"], bits=3).alias("z")).distinct().count() > 100
    with pytest.raises(ValueError, match="bits"):
        interleaved(df, ["a"] * 8)
    with pytest.raises(ValueError, match="cannot be clustered"):
        interleaved(df.withColumn("x", F.array("a")), ["x"])


def test_clustered_edge_cases(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (1, None), (1, "b"), (1, "b")], "k int, s string")
    write_clustered(df, str(tmp_path / "t"), ["k", "s"])
    assert values(spark.read.parquet(str(tmp_path / "t"))) == values(df)
    write_clustered(df.limit(0), str(tmp_path / "e"), ["k", "s"], n_files=3)
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0


# -- parity ------------------------------------------------------------------------------

pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", None, "b"])), max_size=12)


@settings(max_examples=15, deadline=None)
@given(pairs, pairs, st.sampled_from([1, 2, 64]))
def test_both_ways_find_the_same(spark, left, right, buckets):
    a, b = (spark.createDataFrame(rows, "k int, s string") for rows in (left, right))
    assert values(parity_in_buckets(a, b, buckets)) == values(parity(a, b))


def test_only_differing_buckets_are_compared(spark):
    left = spark.range(20_000).select("id", (F.col("id") % 7).cast("double").alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 777, 0.5).otherwise(F.col("v")))
    assert differing_buckets(left, left.select("*")) == []
    buckets = differing_buckets(left, right, 1000)
    assert 1 <= len(buckets) <= 2
    assert values(parity_in_buckets(left, right, 1000), "id", "only_in", "n_rows") == [(777, "left", 1), (777, "right", 1)]
    inside = left.filter((F.pmod(F.xxhash64("id", "v"), F.lit(1000))).isin(buckets))
    assert inside.count() < 100
    assert parity_in_buckets(left.union(left), left.union(left)).count() == 0
    assert parity_in_buckets(left.union(left.limit(1)), left).count() == 1
    with pytest.raises(ValueError, match="types differ"):
        parity_in_buckets(left, left.withColumn("id", F.col("id").cast("int")))


def test_opened_folders(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 10 AS part").write.partitionBy("part").parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    folders, files = scanned_partitions(df.filter("part < 3"))
    assert folders == 3 and files >= 3 and scanned_partitions(df)[0] == 10


# -- pages --------------------------------------------------------------------------------


def test_pages_as_a_stream(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    found, schema = SnapshotTable(spark, str(tmp_path / "t")), "k int"

    def put(n, *keys):
        (folder / f"p{n}.json").write_text(json.dumps([{"k": k} for k in keys]))

    def run(**options):
        stream = stream_paged(spark, f"file://{folder}/p{{page}}.json", schema, pages_per_task=2, **options)
        append_sink(stream, found, str(tmp_path / "c")).awaitTermination()
        return [k for (k,) in values(found.read())] if found.exists() else []

    assert run(page_size=2) == []
    put(1, 1, 2), put(2, 3, 4), put(3, 5)
    assert run(page_size=2) == [1, 2, 3, 4]  # the third page is still being filled
    put(1, 99, 99)  # pages that have been read are not asked for again
    put(3, 5, 6), put(4, 7, 8)
    assert run(page_size=2) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert run(page_size=2) == [1, 2, 3, 4, 5, 6, 7, 8]
    with pytest.raises(Exception, match="numbered pages"):
        spark.readStream.format("paged_json").schema(schema).options(url="file:///x", mode="keys").load().writeStream.format("noop").option(
            "checkpointLocation", str(tmp_path / "d")
        ).start().processAllAvailable()


@pytest.mark.parametrize("n", [1, 200_000])
def test_pages_of_the_stream_stay_as_long(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(shapes, "work_folder", lambda _, name: str(tmp_path / name))
    orders = spark.range(n).selectExpr("id AS o_orderkey", "IF(id % 3 = 0, NULL, 'F') AS o_orderstatus")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    df = shapes.paged_stream(spark, str(tmp_path))
    assert df.count() == n and df.exceptAll(orders).isEmpty()
    lengths = [len(p.read_text().splitlines()) for p in (tmp_path / "added-pages").glob("page-*.json")]
    assert sum(lengths) == n and max(lengths) <= PAGE_ROWS
