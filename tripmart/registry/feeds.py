"""The test tables in the shape of trip feeds.

Line items of odd orders act as the green feed, those of even orders as the
yellow one; nations act as zones. The column expressions are SQL that Spark and
the checking engine both read, so both sides see the same feeds; everything
after them is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmart.plans import (
    conform_green,
    conform_yellow,
    dim_zones,
    fact_rows,
    int_trips,
    union_services,
)
from tripmart.schemas import PAYMENT_DESCRIPTIONS, payment_lookup

COMMON = {
    "vendorid": "nullif(l_partkey % 6, 5)",
    "pulocationid": "l_suppkey % 27",
    "dolocationid": "l_partkey % 26",
    "passenger_count": "nullif(l_linenumber, 6)",
    "trip_distance": "l_quantity * 0.5",
    "store_and_fwd_flag": "l_returnflag",
    "fare_amount": "l_extendedprice",
    "extra": "l_tax",
    "mta_tax": "CAST(0.5 AS DOUBLE)",
    "tip_amount": "l_discount",
    "tolls_amount": "l_tax",
    "improvement_surcharge": "CAST(0.3 AS DOUBLE)",
    "total_amount": "l_extendedprice",
}
GREEN = {
    **COMMON,
    "ratecodeid": "CASE l_partkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN NULL "
    "ELSE CAST(l_partkey % 5 AS STRING) END",
    "trip_type": "CASE l_partkey % 3 WHEN 0 THEN 'x' ELSE CAST(l_partkey % 3 AS STRING) END",
    "ehail_fee": "CASE WHEN l_partkey % 2 = 0 THEN l_tax END",
    "payment_type": "CASE l_quantity WHEN 50 THEN NULL WHEN 49 THEN 'x' "
    "ELSE CAST(l_linenumber AS STRING) END",
}
YELLOW = {
    **COMMON,
    "ratecodeid": "CASE l_partkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN '1.0' WHEN 2 THEN '2.5' "
    "WHEN 3 THEN '-1.5' ELSE NULL END",
    "payment_type": "CASE WHEN l_quantity < 50 THEN l_linenumber END",
}
PICKUP_SECONDS = "CAST((l_partkey % 48) * 1800 AS INT)"
TRIP_SECONDS = "CAST(nullif(l_linenumber, 7) + l_quantity * 67 AS INT)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and stamps as wall-clock, for comparison."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(name))
    return df.select(*columns)


def _raw(lines: DataFrame, columns: dict[str, str], prefix: str) -> DataFrame:
    start = f"timestampadd(SECOND, {PICKUP_SECONDS}, l_shipdate)"
    return lines.selectExpr(
        *[f"{sql} AS {name}" for name, sql in columns.items()],
        f"{start} AS {prefix}_pickup_datetime",
        f"timestampadd(SECOND, {TRIP_SECONDS}, {start}) AS {prefix}_dropoff_datetime",
    )


def raw_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "lineitem").filter("l_orderkey % 2 = 1"), GREEN, "lpep")


def raw_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(table(spark, sf_dir, "lineitem").filter("l_orderkey % 2 = 0"), YELLOW, "tpep")


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones; the last one carries the name given to a missing zone."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    name = F.when(F.col("n_nationkey") == 24, "Unknown Zone").otherwise(F.col("n_name"))
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        name.alias("Zone"),
        F.concat(F.lit("Service "), "r_name").alias("service_zone"),
    )


def unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_services(
        conform_green(raw_green(spark, sf_dir)), conform_yellow(raw_yellow(spark, sf_dir))
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return int_trips(unioned(spark, sf_dir), payment_lookup(spark))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones(zone_seed(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(trips(spark, sf_dir), zones(spark, sf_dir))


# -- the same, for the checking engine ------------------------------------

_MONEY = (
    "fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge total_amount".split()
)


def _sql_raw(columns: dict[str, str], prefix: str, odd: int) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    start = f"l_shipdate + to_seconds({PICKUP_SECONDS})"
    return (
        f"SELECT {listed}, {start} AS {prefix}_pickup_datetime, "
        f"{start} + to_seconds({TRIP_SECONDS}) AS {prefix}_dropoff_datetime "
        f"FROM lineitem WHERE l_orderkey % 2 = {odd}"
    )


def _sql_conformed(
    raw: str, prefix: str, rate: str, kind: str, fee: str, payment: str, service: str
) -> str:
    money = ", ".join(f"CAST({c} AS DECIMAL(38,9)) AS {c}" for c in _MONEY)
    return (
        f"SELECT CAST(vendorid AS INTEGER) AS vendor_id, {rate} AS rate_code_id, "
        "CAST(pulocationid AS INTEGER) AS pickup_location_id, "
        "CAST(dolocationid AS INTEGER) AS dropoff_location_id, "
        f"{prefix}_pickup_datetime AS pickup_datetime, "
        f"{prefix}_dropoff_datetime AS dropoff_datetime, store_and_fwd_flag, "
        "CAST(passenger_count AS INTEGER) AS passenger_count, "
        f"CAST(trip_distance AS DECIMAL(38,9)) AS trip_distance, {kind} AS trip_type, "
        f"{money}, {fee} AS ehail_fee, {payment} AS payment_type, '{service}' AS service_type "
        f"FROM {raw} WHERE vendorid IS NOT NULL"
    )


def _sql_lookup() -> str:
    rows = ", ".join(f"({code}, '{text}')" for code, text in PAYMENT_DESCRIPTIONS.items())
    return f"SELECT * FROM (VALUES {rows}) AS v(code, description)"


_INT = "TRY_CAST({} AS INTEGER)".format

RAW_CTE = f"""
raw_green AS ({_sql_raw(GREEN, "lpep", 1)}),
raw_yellow AS ({_sql_raw(YELLOW, "tpep", 0)})"""

UNION_CTE = f"""{RAW_CTE},
green AS ({_sql_conformed(
    "raw_green", "lpep", _INT("ratecodeid"), _INT("trip_type"),
    "CAST(ehail_fee AS DECIMAL(38,9))", _INT("payment_type"), "Green")}),
yellow AS ({_sql_conformed(
    "raw_yellow", "tpep", "CAST(round(TRY_CAST(ratecodeid AS DOUBLE)) AS INTEGER)",
    "CAST(1 AS INTEGER)", "CAST(0 AS DECIMAL(38,9))", "CAST(payment_type AS INTEGER)", "Yellow")}),
unioned AS (SELECT * FROM green UNION ALL BY NAME SELECT * FROM yellow)"""

TRIPS_CTE = f"""{UNION_CTE},
lookup AS ({_sql_lookup()}),
first_trips AS (
  SELECT * FROM unioned
  QUALIFY row_number() OVER (
    PARTITION BY vendor_id, pickup_datetime, pickup_location_id, service_type
    ORDER BY dropoff_datetime NULLS FIRST, rate_code_id NULLS FIRST,
      dropoff_location_id NULLS FIRST, store_and_fwd_flag NULLS FIRST,
      passenger_count NULLS FIRST, trip_distance NULLS FIRST, trip_type NULLS FIRST,
      fare_amount NULLS FIRST, extra NULLS FIRST, mta_tax NULLS FIRST,
      tip_amount NULLS FIRST, tolls_amount NULLS FIRST, ehail_fee NULLS FIRST,
      improvement_surcharge NULLS FIRST, total_amount NULLS FIRST,
      payment_type NULLS FIRST) = 1),
trips AS (
  SELECT f.* REPLACE (coalesce(f.payment_type, 0) AS payment_type),
    coalesce(l.description, 'Unknown') AS payment_type_description,
    md5(concat_ws('-', CAST(vendor_id AS VARCHAR), CAST(pickup_datetime AS VARCHAR),
      CAST(pickup_location_id AS VARCHAR), service_type)) AS trip_id
  FROM first_trips f LEFT JOIN lookup l ON coalesce(f.payment_type, 0) = l.code)"""

ZONES_CTE = """
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough,
    CASE WHEN n_nationkey = 24 THEN 'Unknown Zone' ELSE n_name END AS zone,
    'Service ' || r_name AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

FACT_CTE = f"""{TRIPS_CTE},{ZONES_CTE},
fact AS (
  SELECT t.*, p.borough AS pickup_borough, p.zone AS pickup_zone,
    d.borough AS dropoff_borough, d.zone AS dropoff_zone,
    CAST(date_diff('minute', pickup_datetime, dropoff_datetime) AS BIGINT)
      AS trip_duration_minutes
  FROM trips t
  LEFT JOIN zones p ON t.pickup_location_id = p.location_id
  LEFT JOIN zones d ON t.dropoff_location_id = d.location_id)"""

MONEY_LIST = [*_MONEY, "ehail_fee", "trip_distance"]


def as_doubles(*columns: str) -> str:
    """A REPLACE list that turns decimals into doubles."""
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
