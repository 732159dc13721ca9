"""Queries that write a table and read it back.

Each run writes to a fresh folder below the shared work folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmart.operators import between_dates_inclusive, count_by, row_count
from tripmart.plans import build_fact, refresh_report, refresh_staging
from tripmart.quality import file_stats, not_null, partition_sizes, unique
from tripmart.registry import feeds
from tripmart.registry.base import registry
from tripmart.registry.feeds import plain, table
from tripmart.session import work_folder
from tripmart.sinks import write_day, write_layout, write_pages, write_parquet, write_partitioned
from tripmart.sources import (
    explode_children,
    load_seed,
    read_csv_inferred,
    read_csv_typed,
    read_months,
    read_paged,
    read_parquet,
)
from tripmart.tables import (
    SnapshotTable,
    append,
    as_table,
    as_view,
    create_keyed_table,
    delete_insert,
    merge,
    register_external,
    replace,
    time_interval,
)

QUERIES, ORACLES, query = registry()


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _event_table(spark: SparkSession, name: str, rows: DataFrame) -> SnapshotTable:
    target = SnapshotTable(spark, work_folder(spark, name), time="ts")
    replace(target, rows)
    return target


# -- files ------------------------------------------------------------------------


@query(
    """SELECT DISTINCT user_id FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'"""
)
def distinct_in_range(spark, sf):
    path = work_folder(spark, "by-day")
    write_partitioned(_events(spark, sf), path, day_of="ts", cluster="user_id")
    stored = spark.read.parquet(path)
    day = F.col("ts_day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-16").cast("date"))
    exact = between_dates_inclusive("ts", "2024-01-10", "2024-01-16")
    return stored.filter(day & exact).select("user_id").distinct()


@query(
    """SELECT CAST(4 AS BIGINT) AS n_files, (SELECT count(*) FROM orders) AS n_rows,
      (SELECT count(*) FROM orders) AS n_rows_kept"""
)
def file_layout(spark, sf):
    path = work_folder(spark, "four-files")
    orders = table(spark, sf, "orders")
    write_parquet(orders, path, n_files=4)
    kept = write_layout(orders, work_folder(spark, "layout"), "rides", "orders")
    files = file_stats(spark, path).select("n_files")
    rows = row_count(read_parquet(spark, path, columns=["o_orderkey"]), "n_rows")
    again = row_count(read_parquet(spark, kept, columns=["o_orderkey"]), "n_rows_kept")
    named = [
        df.select(F.lit(c).alias("what"), F.col(c).alias("value"))
        for df, c in ((files, "n_files"), (rows, "n_rows"), (again, "n_rows_kept"))
    ]
    stacked = named[0].unionByName(named[1]).unionByName(named[2])
    return stacked.agg(
        *[
            F.max(F.when(F.col("what") == c, F.col("value"))).alias(c)
            for c in ("n_files", "n_rows", "n_rows_kept")
        ]
    )


@query(
    """SELECT o_orderstatus, DATE '2024-05-01' AS day, count(*) AS n FROM orders
      WHERE o_totalprice > 250000 GROUP BY o_orderstatus
    UNION ALL
    SELECT o_orderstatus, DATE '2024-05-02', count(*) FROM orders GROUP BY o_orderstatus"""
)
def run_days(spark, sf):
    path = work_folder(spark, "run-days")
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    write_day(orders, path, "2024-05-01")
    write_day(orders, path, "2024-05-02")
    write_day(orders.filter("o_totalprice > 250000"), path, "2024-05-01")
    return count_by(spark.read.parquet(path), "o_orderstatus", "day")


ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@query(
    """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus, o_totalprice,
      o_orderdate, o_orderpriority FROM orders"""
)
def csv_typed(spark, sf):
    path = work_folder(spark, "csv")
    formats = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "compression": "gzip"}
    table(spark, sf, "orders").write.options(header=True, **formats).csv(path)
    return read_csv_typed(spark, path, schema=ORDERS, null_tokens=["F"])


@query(
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys
    FROM orders GROUP BY o_orderstatus"""
)
def csv_inferred(spark, sf):
    path = work_folder(spark, "csv")
    table(spark, sf, "orders").select("o_orderstatus", "o_custkey").write.csv(path, header=True)
    stored = read_csv_inferred(spark, path)
    return stored.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("o_custkey").cast("bigint").alias("keys")
    )


@query("SELECT s_suppkey, s_name FROM supplier")
def checked_seed(spark, sf):
    path = work_folder(spark, "seed")
    table(spark, sf, "supplier").select("s_suppkey", "s_name").write.csv(path, header=True)
    schema = T.StructType(
        [T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())]
    )
    checks = [not_null("s_suppkey"), unique("s_suppkey"), not_null("s_name")]
    return load_seed(spark, path, schema, checks)


MONTHLY_FILLED = (
    "passenger_count trip_distance fare_amount extra mta_tax tip_amount tolls_amount "
    "improvement_surcharge"
).split()


@query(
    """WITH trips AS (
      SELECT CASE WHEN event_type IN ('click', 'view') THEN 'yellow' ELSE 'green' END AS taxi_type,
        CAST(date_trunc('month', ts + to_months(
          CASE WHEN value < 3 THEN 0 WHEN value < 15 THEN 1 ELSE 2 END)) AS DATE) AS month,
        value
      FROM events)
    SELECT taxi_type, month, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM trips GROUP BY taxi_type, month"""
)
def monthly_files(spark, sf):
    # The events as trips of three months and two services, in one file set each.
    base = work_folder(spark, "months")
    events = table(spark, sf, "events")
    is_yellow = F.col("event_type").isin("click", "view")
    later = F.when(F.col("value") < 3, 0).when(F.col("value") < 15, 1).otherwise(2)
    for kind, stamps, of_kind in (("yellow", "tpep", is_yellow), ("green", "lpep", ~is_yellow)):
        for shift, month in enumerate(("2024-01", "2024-02", "2024-03")):
            trips = events.filter(of_kind & (later == shift)).select(
                F.col("user_id").alias("VendorID"),
                (F.col("ts") + F.make_ym_interval(months=F.lit(shift))).alias(
                    f"{stamps}_pickup_datetime"
                ),
                F.col("ts").alias(f"{stamps}_dropoff_datetime"),
                F.col("value").alias("total_amount"),
                *[F.lit(0).alias(c) for c in ("RatecodeID", "PULocationID", "DOLocationID")],
                *[F.lit(0.5).alias(c) for c in MONTHLY_FILLED],
                F.lit("N").alias("store_and_fwd_flag"),
                F.lit(1).alias("payment_type"),
            )
            write_parquet(trips, f"{base}/{kind}_tripdata_{month}.parquet")
    trips = read_months(spark, base, "2024-01-01", "2024-05-01", on_missing="skip")
    grouped = trips.groupBy(
        "taxi_type", F.trunc(F.to_date("pickup_datetime"), "month").alias("month")
    )
    amount = F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("amount")
    return plain(grouped.agg(F.count("*").alias("n"), amount))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def external_table(spark, sf):
    external = register_external(spark, f"external_{uuid.uuid4().hex}", f"{sf}/lineitem.parquet")
    return count_by(external, "l_returnflag")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def external_partitioned(spark, sf):
    path = work_folder(spark, "external")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    lines.write.partitionBy("l_returnflag").parquet(path)
    external = register_external(spark, f"external_{uuid.uuid4().hex}", path)
    return count_by(external, "l_returnflag", "l_linestatus")


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey")
def saved_table(spark, sf):
    counts = count_by(table(spark, sf, "customer"), "c_nationkey")
    name = f"saved_counts_{uuid.uuid4().hex}"
    saved = as_table(counts, name, work_folder(spark, "saved"))
    as_view(saved, f"{name}_view")
    return spark.sql(f"SELECT c_nationkey, n FROM {name}_view")


@query(
    """SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_partitions, max(c) AS largest
    FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_linenumber % 5)"""
)
def partition_rows(spark, sf):
    # One partition per remainder of the line number.
    remainder = (F.col("l_linenumber") % 5).cast("int")
    sizes = partition_sizes(table(spark, sf, "lineitem").repartitionById(5, remainder))
    return sizes.agg(
        F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_partitions"), F.max("n_rows").alias("largest")
    )


# -- JSON documents -----------------------------------------------------------------


@query(
    """SELECT o_orderkey, 'child' AS part, CAST(0 AS BIGINT) AS position, o_orderstatus AS code,
      o_totalprice AS detail__amount FROM orders WHERE o_orderkey % 3 > 0
    UNION ALL
    SELECT o_orderkey, 'child', 1, o_orderpriority, o_totalprice / 2 FROM orders
    WHERE o_orderkey % 3 = 2
    UNION ALL
    SELECT o_orderkey, 'parent', NULL, CAST(o_custkey AS VARCHAR), NULL FROM orders"""
)
def nested_children(spark, sf):
    def element(code: str, amount):
        return F.struct(
            F.col(code).alias("code"), F.struct(F.col(amount).alias("amount")).alias("detail")
        )

    both = F.array(element("o_orderstatus", "o_totalprice"), element("o_orderpriority", "half"))
    documents = (
        table(spark, sf, "orders")
        .withColumn("half", F.col("o_totalprice") / 2)
        .select(
            "o_orderkey",
            F.struct(F.col("o_custkey").alias("key")).alias("customer"),
            F.slice(both, F.lit(1), (F.col("o_orderkey") % 3).cast("int")).alias("parts"),
        )
    )
    path = work_folder(spark, "documents")
    documents.write.json(path)
    parent, child = explode_children(spark.read.json(path), "parts", "o_orderkey")
    children = child.select(
        "o_orderkey",
        F.lit("child").alias("part"),
        F.col("position").cast("bigint").alias("position"),
        "code",
        "detail__amount",
    )
    parents = parent.select(
        "o_orderkey",
        F.lit("parent").alias("part"),
        F.lit(None).cast("bigint").alias("position"),
        F.col("customer__key").cast("string").alias("code"),
        F.lit(None).cast("double").alias("detail__amount"),
    )
    return children.unionByName(parents)


PAGE = T.StructType(
    [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())]
)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def paged_source(spark, sf):
    # The files Spark writes are the resources of the API, one call each.
    folder = work_folder(spark, "pages")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    names = write_pages(orders, folder)
    base = folder if "://" in folder else f"file://{folder}"
    return read_paged(spark, f"{base}/{{key}}", PAGE, "keys", keys=names, pages_per_task=2)


# -- materialisation ------------------------------------------------------------------


@query(
    """SELECT event_id, ts, user_id, event_type,
      CASE WHEN event_type = 'purchase' THEN value + 1000 ELSE value END AS value
    FROM events"""
)
def merge_upsert(spark, sf):
    # Purchases are updated, sign-ups are new, the others stay.
    events = _events(spark, sf)
    target = _event_table(spark, "merge", events.filter("event_type <> 'signup'"))
    changed = events.filter("event_type IN ('purchase', 'signup')").withColumn(
        "value", F.expr("CASE WHEN event_type = 'purchase' THEN value + 1000 ELSE value END")
    )
    merge(target, changed, ["event_id"])
    merge(target, changed, ["event_id"])
    return target.read()


@query(
    """SELECT event_id, ts, user_id, event_type, value,
      CASE WHEN event_type IN ('purchase', 'signup') THEN 'new' END AS note
    FROM events"""
)
def widen(spark, sf):
    events = _events(spark, sf)
    target = _event_table(spark, "widen", events.filter("event_type <> 'signup'"))
    noted = events.filter("event_type IN ('purchase', 'signup')").withColumn("note", F.lit("new"))
    merge(target, noted, ["event_id"], widen=True)
    return target.read()


@query(
    """SELECT event_id, ts, user_id, event_type, value FROM events
      WHERE event_type NOT IN ('click', 'view')
    UNION ALL
    SELECT event_id, ts, user_id, event_type, value * 2 FROM events
      WHERE event_type IN ('click', 'view') AND value > 5"""
)
def delete_and_insert(spark, sf):
    # Each of the two types holds a large share of the rows.
    events = _events(spark, sf)
    target = _event_table(spark, "delete-insert", events)
    recomputed = events.filter("event_type IN ('click', 'view') AND value > 5")
    delete_insert(target, recomputed.withColumn("value", F.col("value") * 2), ["event_type"])
    return target.read()


@query(
    """SELECT event_id, ts, user_id, event_type, value FROM events
      WHERE NOT (ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00')
    UNION ALL
    SELECT event_id, ts, user_id, event_type, value * 2 FROM events
      WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'
        AND CAST(ts AS DATE) <> DATE '2024-01-07'"""
)
def rebuild_interval(spark, sf):
    events = _events(spark, sf)
    target = _event_table(spark, "interval", events)
    start, end = "2024-01-05 06:00:00", "2024-01-09 00:00:00"
    inside = events.filter((F.col("ts") >= _at(start)) & (F.col("ts") < _at(end)))
    # One day becomes empty.
    rows = inside.filter(F.to_date("ts") != F.lit("2024-01-07").cast("date")).withColumn(
        "value", F.col("value") * 2
    )
    time_interval(target, rows, "ts", start, end)
    time_interval(target, rows, "ts", start, end)
    return target.read()


@query(
    """SELECT event_id, ts, user_id, event_type, value FROM events
    UNION ALL
    SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'click'"""
)
def append_rows(spark, sf):
    events = _events(spark, sf)
    target = create_keyed_table(
        spark, work_folder(spark, "append"), events.schema, ["event_id"], time="ts"
    )
    append(target, events, batch=("load", 1))
    append(target, events, batch=("load", 1))
    append(target, events.filter("event_type = 'click'"), batch=("load", 2))
    return target.read()


@query(
    """SELECT CAST(ts AS DATE) AS report_date, event_type AS taxi_type, count(*) AS total_trips,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
      CAST(sum(user_id) AS BIGINT) AS total_passengers, count(DISTINCT user_id) AS unique_vendors
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-29'
    GROUP BY CAST(ts AS DATE), event_type"""
)
def rebuild_report(spark, sf):
    # Ingested trips to staging to report, in two overlapping interval runs.
    money = F.col("value").cast("decimal(18,2)")
    ingested = table(spark, sf, "events").select(
        F.col("ts").alias("pickup_datetime"),
        F.col("event_type").alias("taxi_type"),
        *[money.alias(c) for c in ("total_amount", "trip_distance", "fare_amount", "tip_amount")],
        F.col("user_id").alias("passenger_count"),
        F.col("user_id").alias("vendor_id"),
    )
    staging = SnapshotTable(spark, work_folder(spark, "staging"), time="pickup_datetime")
    report = SnapshotTable(spark, work_folder(spark, "report"), time="report_date", grain="month")
    for start, end in (("2024-01-03", "2024-01-20"), ("2024-01-15", "2024-01-29")):
        refresh_staging(ingested, staging, start, end)
        refresh_report(staging, report, start, end)
    return plain(
        report.read().select(
            "report_date", "taxi_type", "total_trips", "total_revenue", "total_passengers",
            "unique_vendors",
        )
    )


@query(
    f"""WITH {feeds.FACT_CTE}
    SELECT * REPLACE ({feeds.as_doubles(*feeds.MONEY_LIST)}) FROM fact"""
)
def incremental_fact(spark, sf):
    # Slices in time order give the same table as one full build. The trips are
    # a table, as is the fact: a run reads only the periods it adds.
    trips, target = (
        SnapshotTable(spark, work_folder(spark, name), time="pickup_datetime", grain="month")
        for name in ("trips", "fact")
    )
    zones = feeds.zones(spark, sf)
    path = work_folder(spark, "enriched")
    feeds.trips(spark, sf).write.parquet(path)
    enriched = spark.read.parquet(path)
    cut = _at("1998-06-15 12:00:00")
    replace(trips, enriched.filter(F.col("pickup_datetime") < cut))
    build_fact(trips, zones, target)
    append(trips, enriched.filter(F.col("pickup_datetime") >= cut))
    build_fact(trips, zones, target)
    return plain(target.read())
