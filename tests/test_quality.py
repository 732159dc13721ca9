import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan, values
from tripmart.operators import row_count
from tripmart.quality import (
    CheckFailed,
    accepted_values,
    check_report,
    custom_check,
    describe_table,
    enforce_contract,
    file_stats,
    freshness,
    non_negative,
    not_null,
    parity,
    partition_sizes,
    positive,
    relationships,
    require_passed,
    scan_estimate,
    table_shape,
    unique,
    unique_combination,
)
from tripmart.schemas import PAYMENT_NAMES, PAYMENT_TYPES, SERVICE_TYPES, payment_lookup


@pytest.fixture
def table(spark):
    rows = [(1, "Green", 5, 1), (1, "Green", 0, 9), (None, "Red", -1, 9), (None, None, None, None), (2, "Yellow", 1, 1)]
    return spark.createDataFrame(rows, "k int, s string, n int, fk int")


def outcomes(report):
    return {(r["check_name"], r["column_name"]): (r["failures"], r["passed"]) for r in report.collect()}


def test_each_check_failing(spark, table):
    table.createOrReplaceTempView("checked")
    parent = spark.createDataFrame([(1,), (1,)], "pk int")
    report = check_report(table, [
        not_null("k"), accepted_values("s", SERVICE_TYPES), positive("n"), non_negative("n"), unique("k"),
        unique_combination("k", "s"), relationships("fk", parent, "pk"),
        custom_check("few", "SELECT count(*) > 9 FROM checked", 1),
        custom_check("five", "SELECT count(*) FROM checked", 4),
        custom_check("nothing", "SELECT 1 WHERE false", 1),
    ])
    assert outcomes(report) == {
        ("not_null", "k"): (2, False), ("accepted_values", "s"): (1, False), ("positive", "n"): (2, False),
        ("non_negative", "n"): (1, False), ("unique", "k"): (1, False),
        ("unique_combination", "k, s"): (1, False), ("relationships", "fk"): (2, False),
        ("custom", "few"): (1, False), ("custom", "five"): (1, False), ("custom", "nothing"): (1, False),
    }
    with pytest.raises(CheckFailed, match=r"not_null\(k\): 2"):
        require_passed(report)


def test_each_check_passing_and_empty_table(spark, table):
    good = table.filter("k = 2")
    good.createOrReplaceTempView("good")
    parent = spark.createDataFrame([(1,)], "pk int")
    checks = [
        not_null("k"), accepted_values("s", SERVICE_TYPES), positive("n"), non_negative("n"), unique("k"),
        unique_combination("k", "s"), relationships("fk", parent, "pk"),
    ]
    some = [*checks, custom_check("any", "SELECT count(*) > 0 FROM good", 1), custom_check("one", "SELECT count(*) FROM good", 1)]
    assert require_passed(check_report(good, some)).count() == 9
    assert require_passed(check_report(table.limit(0), checks)).count() == 7


def test_row_checks_share_one_pass(table):
    report = check_report(table, [not_null("k"), not_null("s"), positive("n"), non_negative("n")])
    assert plan(report).count("Scan ExistingRDD") == 1


def test_seed_checks(spark):
    names = payment_lookup(spark, PAYMENT_NAMES)
    require_passed(check_report(names, [not_null("payment_type"), unique("payment_type"), not_null("description")]))
    assert values(names.filter("payment_type = 0"), "description") == [("flex_fare",)]
    assert names.schema == PAYMENT_TYPES


@pytest.mark.parametrize("hours, state", [(0, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, state):
    newest = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(newest,), (newest - dt.timedelta(days=9),), (None,)], "t timestamp_ntz")
    row = freshness(df, "t", newest + dt.timedelta(hours=hours)).first()
    assert (row["newest_at"], row["age_hours"], row["state"]) == (newest, float(hours), state)


def test_freshness_of_an_empty_table(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert freshness(df, "t", dt.datetime(2024, 1, 1)).first()["state"] == "error"


def test_contract(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    assert enforce_contract(df, schema).columns == ["a", "b"]
    with pytest.raises(ValueError, match="a: missing"):
        enforce_contract(df.drop("a"), schema)
    with pytest.raises(ValueError, match="a: bigint instead of int"):
        enforce_contract(df.withColumn("a", F.col("a").cast("bigint")), schema)
    wider = df.withColumn("c", F.lit(1))
    with pytest.raises(ValueError, match="c: not in the contract"):
        enforce_contract(wider, schema)
    assert enforce_contract(wider, schema, allow_new=True).columns == ["a", "b", "c"]


def test_inspection(spark, table, tmp_path):
    assert describe_table(table)[0] == ("k", "int", True)
    assert values(table_shape(table)) == [(5, 4)]
    assert sum(r["n_rows"] for r in partition_sizes(table.repartition(2)).collect()) == 5
    path = str(tmp_path / "files")
    table.repartition(4).write.partitionBy("s").parquet(path)
    stats = file_stats(spark, path).first()
    assert stats["n_files"] >= 4 and stats["total_bytes"] > 0 and 0 < stats["avg_file_mb"] < 1


def test_scan_estimate_sees_columns_and_partitions(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(100_000).selectExpr("id", "id * 2 AS twice", "id % 10 AS part").write.partitionBy("part").parquet(path)
    whole = spark.read.parquet(path)
    all_bytes = scan_estimate(whole)
    assert scan_estimate(whole.select("id")) == pytest.approx(all_bytes / 2, rel=0.1)
    assert scan_estimate(whole.filter("part = 3")) == pytest.approx(all_bytes / 10, rel=0.2)
    assert scan_estimate(row_count(whole)) == 0


def test_parity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert parity(a, a.select("k")).count() == 0
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert values(parity(a, b)) == [(1, "left", 1), (2, "left", 1), (3, "right", 1)]


def test_no_checks_give_an_empty_report(spark, table):
    report = check_report(table, [])
    assert report.count() == 0 and report.columns == ["check_name", "column_name", "failures", "passed"]
    require_passed(report)


def test_unknown_sizes_are_an_error(spark, table):
    assert scan_estimate(spark.range(5).toDF("k")) == 0
    with pytest.raises(ValueError, match="not known"):
        scan_estimate(spark.createDataFrame(table.rdd, table.schema))
