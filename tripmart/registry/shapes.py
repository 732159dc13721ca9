"""Queries over data whose shape varies: documents, growing types and pages, layouts, whole runs with their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmart.operators import total
from tripmart.plans import dim_vendors, refresh_monthly, run_interval
from tripmart.plans.rules import monthly_rules, payment_rules, vendor_rules, zone_rules
from tripmart.quality import check_report, parity_in_buckets, scanned_partitions
from tripmart.registry import feeds
from tripmart.registry.base import registry
from tripmart.registry.feeds import plain, table
from tripmart.schemas import payment_lookup
from tripmart.session import work_folder
from tripmart.sinks import append_sink, write_clustered, write_pages, write_partitioned
from tripmart.sources import explode_documents, field_kinds, read_documents, split_kinds, stream_paged
from tripmart.tables import SnapshotTable, append, create_table_ddl, merge

QUERIES, ORACLES, query = registry()

# -- documents ----------------------------------------------------------------------


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose amount is a number, a text or an object, some with their status in a list of parts."""
    kind, amount = F.col("o_orderkey") % 4, F.col("o_totalprice")
    text = F.to_json(F.struct(amount.alias("value"), F.lit("EUR").alias("unit")))
    value = (
        F.when(kind == 0, amount.cast("string"))
        .when(kind == 1, F.concat(F.lit('"'), amount.cast("string"), F.lit('"')))
        .when(kind == 2, text)
    )
    part = F.concat(F.lit('{"status": "'), F.col("o_orderstatus"), F.lit('", "amount": '), value, F.lit("}"))
    other = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"'))
    parts = F.when(kind == 3, F.lit("null")).otherwise(F.concat(F.lit("["), part, F.lit(", "), other, F.lit("]")))
    document = F.concat(F.lit('{"key": '), F.col("o_orderkey"), F.lit(', "parts": '), parts, F.lit("}"))
    path = work_folder(spark, "unknown")
    table(spark, sf, "orders").select(document).write.text(path)
    return read_documents(spark, path)


@query(
    """SELECT o_orderkey AS key, 0 AS position, o_orderstatus AS status,
      CASE o_orderkey % 4 WHEN 0 THEN o_totalprice END AS amount__number,
      CASE o_orderkey % 4 WHEN 1 THEN o_totalprice END AS amount__text,
      CASE o_orderkey % 4 WHEN 2 THEN o_totalprice END AS amount__object,
      CAST(NULL AS VARCHAR) AS element FROM orders WHERE o_orderkey % 4 < 3
    UNION ALL SELECT o_orderkey, 1, NULL, NULL, NULL, NULL, o_orderpriority FROM orders WHERE o_orderkey % 4 < 3"""
)
def variant_children(spark, sf):
    keyed = _documents(spark, sf).withColumn("key", F.variant_get("doc", "$.key", "bigint"))
    parts = explode_documents(keyed, "$.parts", ["key"])
    apart = split_kinds(parts, "$.amount", "amount", ("number", "text", "object"))
    apart = split_kinds(apart, "$", "element", ("text",))
    return apart.select(
        "key",
        "position",
        F.try_variant_get("doc", "$.status", "string").alias("status"),
        F.col("amount__number").cast("double").alias("amount__number"),
        F.col("amount__text").cast("double").alias("amount__text"),
        F.variant_get("amount__object", "$.value", "double").alias("amount__object"),
        F.col("element__text").alias("element"),
    )


@query(
    """SELECT 'key' AS field, 'number' AS kind, count(*) AS n_documents FROM orders
    UNION ALL SELECT 'parts', CASE o_orderkey % 4 WHEN 3 THEN 'null' ELSE 'list' END, count(*) FROM orders GROUP BY ALL"""
)
def variant_kinds(spark, sf):
    return field_kinds(_documents(spark, sf))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def paged_stream(spark, sf):
    # Numbered files are the pages; half of them are there in the first run, the others in the second.
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    given, pages = work_folder(spark, "given"), work_folder(spark, "added-pages")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    names = write_pages(orders, given)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(given).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(pages))
    base = pages if "://" in pages else f"file://{pages}"
    found, checkpoint = SnapshotTable(spark, work_folder(spark, "fetched")), work_folder(spark, "fetched-checkpoint")
    for added in (range(0, len(names) // 2), range(len(names) // 2, len(names))):
        for i in added:
            files.rename(path(f"{given}/{names[i]}"), path(f"{pages}/page-{i + 1}.json"))
        stream = stream_paged(spark, f"{base}/page-{{page}}.json", schema, pages_per_task=2)
        append_sink(stream, found, checkpoint).awaitTermination()
    return found.read()


# -- tables -------------------------------------------------------------------------


@query(
    """SELECT event_id, ts, CAST(CASE WHEN event_id % 3 = 0 THEN user_id ELSE user_id + 4000000000 END AS BIGINT) AS user_id,
      CAST(CASE WHEN event_id % 3 = 0 THEN CAST(value AS REAL) ELSE value END AS DOUBLE) AS value,
      CAST(event_id % 7 AS DOUBLE) + CASE WHEN event_id % 3 = 0 THEN 0 ELSE 0.25 END AS score
    FROM events"""
)
def widened_type(spark, sf):
    # A first load with narrow types, a merge with wider ones: the old files are read as they are.
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    narrow = events.filter("event_id % 3 = 0").select(
        "event_id", "ts", F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("float").alias("value"),
        (F.col("event_id") % 7).cast("int").alias("score"),
    )
    wide = events.filter("event_id % 3 > 0").select(
        "event_id", "ts", (F.col("user_id") + 4_000_000_000).alias("user_id"), "value",
        ((F.col("event_id") % 7) + F.lit(0.25)).cast("decimal(12,2)").alias("score"),
    )
    target = SnapshotTable(spark, work_folder(spark, "widened"), time="ts", grain="month")
    append(target, narrow)
    merge(target, wide, ["event_id"], widen=True)
    return plain(target.read())


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem WHERE l_suppkey <= 5")
def clustered_two_keys(spark, sf):
    # Ordered by part and supplier at once; the filter is on the second key.
    path = work_folder(spark, "two-keys")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    write_clustered(lines, path, ["l_partkey", "l_suppkey"], n_files=16)
    return spark.read.parquet(path).filter("l_suppkey <= 5")


@query(
    """SELECT o_custkey, 'left' AS only_in, count(*) AS n_rows FROM orders
      WHERE o_orderstatus = 'F' GROUP BY o_custkey
    UNION ALL
    SELECT o_custkey, 'right', count(*) FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey"""
)
def bucket_differences(spark, sf):
    # The differences of known_differences, found through fingerprints of buckets.
    orders = table(spark, sf, "orders")
    twice = orders.unionByName(orders.filter("o_orderstatus = 'P'"))
    left = orders.select("o_custkey", "o_orderstatus")
    right = twice.filter("o_orderstatus <> 'F'").select("o_custkey", "o_orderstatus")
    differing = parity_in_buckets(left, right)
    return differing.groupBy("o_custkey", "only_in").agg(total("n_rows").alias("n_rows"))


@query(
    """SELECT CAST(user_id % 10 AS BIGINT) AS bucket, count(*) AS n_events,
      count(DISTINCT CAST(ts AS DATE)) AS n_days, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12') AS days_opened
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY ALL"""
)
def pruned_days(spark, sf):
    # What is counted, and how many day folders the plan opens for it.
    path = work_folder(spark, "days")
    write_partitioned(table(spark, sf, "events").select("ts", "user_id"), path, day_of="ts", cluster="user_id")
    day = F.col("ts_day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    inside = spark.read.parquet(path).filter(day)
    opened, _ = scanned_partitions(inside)
    counts = inside.groupBy((F.col("user_id") % 10).alias("bucket")).agg(
        F.count("*").alias("n_events"), F.countDistinct("ts_day").alias("n_days")
    )
    return counts.withColumn("days_opened", F.lit(opened).cast("bigint"))


@query("SELECT * FROM customer")
def ddl_rows(spark, sf):
    # A table made by the DDL of a frame takes its rows and gives them back.
    rows = table(spark, sf, "customer")
    name = f"ddl_{work_folder(spark, 'd')[-32:]}"
    spark.sql(f"{create_table_ddl(rows, name)} USING parquet LOCATION '{work_folder(spark, name)}'")
    rows.write.insertInto(name)
    return spark.table(name)


# -- whole runs -----------------------------------------------------------------------


@query(
    f"""WITH {feeds.FACT_CTE},
    monthly AS (SELECT DISTINCT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
      date_trunc('month', pickup_datetime) AS month, service_type FROM fact),
    counted AS (
      SELECT (SELECT count(*) FROM monthly WHERE month >= TIMESTAMP '1998-01-01') AS months,
        (SELECT count(*) FROM nation WHERE n_nationkey < 5) AS zones,
        (SELECT count(DISTINCT vendor_id) FROM fact) AS vendors)
    SELECT rules, check_name, column_name, CAST(failures AS BIGINT) AS failures FROM (VALUES
      ('run', 'not_null', 'taxi_type', 0), ('run', 'not_null', 'pickup_datetime', 0), ('run', 'not_null', 'extracted_at', 0),
      ('run', 'non_negative', 'trip_distance', 0), ('run', 'row_count_positive', '', 0),
      ('run', 'not_null', 'report_date', 0), ('run', 'not_null', 'taxi_type', 0), ('run', 'non_negative', 'total_trips', 0),
      ('run', 'non_negative', 'total_revenue', 0), ('run', 'non_negative', 'total_passengers', 0),
      ('run', 'trips_count_positive', 'total_trips', 0),
      ('monthly', 'not_null', 'pickup_zone', 0), ('monthly', 'not_null', 'revenue_month', 0),
      ('monthly', 'not_null', 'service_type', 0), ('monthly', 'not_null', 'revenue_monthly_total_amount', 0),
      ('monthly', 'not_null', 'total_monthly_trips', 0), ('monthly', 'accepted_values', 'service_type', 0),
      ('payment', 'unique', 'payment_type', 2), ('payment', 'not_null', 'payment_type', 1),
      ('zones', 'not_null', 'location_id', 0), ('vendors', 'unique', 'vendor_id', 0)) v(rules, check_name, column_name, failures)
    UNION ALL SELECT 'monthly', 'unique_combination', 'pickup_zone, revenue_month, service_type', months FROM counted
    UNION ALL SELECT 'zones', 'unique', 'location_id', zones FROM counted
    UNION ALL SELECT 'vendors', 'not_null', 'vendor_id', vendors FROM counted"""
)
def interval_checks(spark, sf):
    # A staging and a report run with their checks, then the rules of the other tables over rows with known breaks.
    money = F.col("value").cast("decimal(18,2)")
    ingested = table(spark, sf, "events").select(
        F.col("ts").alias("pickup_datetime"),
        F.col("event_type").alias("taxi_type"),
        *[money.alias(c) for c in ("total_amount", "trip_distance", "fare_amount", "tip_amount")],
        F.col("user_id").alias("passenger_count"),
        F.col("user_id").alias("vendor_id"),
        F.col("ts").alias("extracted_at"),
    )
    staging = SnapshotTable(spark, work_folder(spark, "staging"), time="pickup_datetime")
    report = SnapshotTable(spark, work_folder(spark, "report"), time="report_date", grain="month")
    ran = run_interval(ingested, staging, report, "2024-01-03", "2024-01-29").drop("passed")
    fact = SnapshotTable(spark, work_folder(spark, "fact"), time="pickup_datetime", grain="month")
    append(fact, feeds.fact(spark, sf))
    months = SnapshotTable(spark, work_folder(spark, "months"), time="revenue_month", grain="month")
    refresh_monthly(fact, months)
    monthly = months.read()
    lookup = payment_lookup(spark).select("payment_type")
    more = lookup.filter("payment_type IN (1, 2)").unionByName(lookup.filter("payment_type = 3").select(F.lit(None).cast("int").alias("payment_type")))
    zones = feeds.zones(spark, sf)
    vendors = dim_vendors(fact.read())
    sets = (
        ("monthly", monthly.unionByName(monthly.filter("revenue_month >= DATE '1998-01-01'")), monthly_rules()),
        ("payment", lookup.unionByName(more), payment_rules()),
        ("zones", zones.unionByName(zones.filter("location_id < 5")), zone_rules()),
        ("vendors", vendors.unionByName(vendors.withColumn("vendor_id", F.lit(None).cast("int"))), vendor_rules()),
    )
    every = ran.withColumn("rules", F.lit("run"))
    for name, df, rules in sets:
        every = every.unionByName(check_report(df, rules).drop("passed").withColumn("rules", F.lit(name)))
    return every.select("rules", "check_name", "column_name", "failures")
