"""Queries with faulty messages, several micro-batches, numbered pages and planted rule breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmart.functions import decode_json, encode_json, message_faults, parse_time
from tripmart.operators import head
from tripmart.plans.rules import report_rules, staging_rules, vendor_rules, zone_rules
from tripmart.quality import check_report, scan_estimate
from tripmart.registry.base import registry
from tripmart.registry.events import _SESSIONS, _TUMBLING, PAYLOAD
from tripmart.registry.feeds import plain, table
from tripmart.session import work_folder
from tripmart.sinks import upsert_sink, write_pages, write_partitioned
from tripmart.sources import child_tables, read_paged, read_trip_stream, trip_events
from tripmart.streaming import LateRows, session_count, tumbling_count, watermarked
from tripmart.tables import SnapshotTable, create_table_ddl

QUERIES, ORACLES, query = registry()


def _payload(events: DataFrame) -> DataFrame:
    return events.select(F.col("ts").alias("at"), F.col("user_id").cast("int").alias("user_id"), "event_type", "value")


@query(
    """SELECT CASE event_id % 50 WHEN 0 THEN 'bad json' WHEN 1 THEN 'bad time' WHEN 2 THEN 'no key'
      WHEN 3 THEN 'no time' WHEN 4 THEN 'bad json' ELSE 'good' END AS state, count(*) AS n_messages
    FROM events GROUP BY ALL"""
)
def bad_messages(spark, sf):
    case = F.col("event_id") % 50
    text = F.to_json(
        F.struct(
            F.when(case == 1, "soon").when(case != 3, F.col("ts").cast("string")).alias("at"),
            F.when(case != 2, F.col("user_id").cast("int")).alias("user_id"),
            "event_type",
            "value",
        )
    )
    broken = F.when(case == 0, F.concat(F.lit("{"), text)).when(case == 4, F.lit('{"user_id": "many"}'))
    messages = table(spark, sf, "events").select(F.coalesce(broken, text).alias("value"))
    decoded = trip_events(decode_json(messages, PAYLOAD, on_bad="divert"), "at", on_bad="null")
    return message_faults(decoded, "at", "event_timestamp", "user_id")


@query("SELECT event_id, ts AS at FROM events")
def encoded_micros(spark, sf):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("at", T.StringType())])
    events = table(spark, sf, "events").select("event_id", F.col("ts").alias("at"))
    decoded = decode_json(encode_json(events), schema)
    return decoded.select("event_id", parse_time("at").cast("timestamp_ntz").alias("at"))


BATCHES = 4


def _in_files(spark: SparkSession, rows: list[DataFrame], name: str) -> DataFrame:
    """A stream of JSON messages, a micro-batch for each of some frames in turn."""
    folder = work_folder(spark, name)
    for df in rows:
        encode_json(_payload(df)).coalesce(1).write.mode("append").text(folder)
    return watermarked(trip_events(read_trip_stream(spark, folder, PAYLOAD, per_trigger=1), "at"))


def _slices(events: DataFrame) -> list[DataFrame]:
    """The events in ``BATCHES`` slices of equal length of time."""
    span = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    step = (span["high"] - span["low"]) / BATCHES
    cuts = [span["low"] + step * i for i in range(1, BATCHES)]
    number = sum(((F.col("ts") >= F.lit(str(c)).cast("timestamp_ntz")).cast("int") for c in cuts), F.lit(0))
    return [events.filter(number == i) for i in range(BATCHES)]


def _result(df: DataFrame, name: str, keys: list[str]) -> tuple[DataFrame, object]:
    spark = df.sparkSession
    target = SnapshotTable(spark, work_folder(spark, name), time=keys[0])
    stream = upsert_sink(df, target, work_folder(spark, f"{name}-checkpoint"), keys)
    stream.awaitTermination()
    return target.read(), stream


@query(_TUMBLING)
def stream_tumbling_batches(spark, sf):
    stream = _in_files(spark, _slices(table(spark, sf, "events")), "tumbling-files")
    counts = tumbling_count(stream, "5 minutes", "event_type")
    return plain(_result(counts, "tumbling-batches", ["window_start", "event_type"])[0])


@query(
    _SESSIONS
    + """SELECT session_start, session_end, CAST(user_id AS INTEGER) AS user_id, num_trips
    FROM sessions WHERE session_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)"""
)
def stream_session_batches(spark, sf):
    stream = _in_files(spark, _slices(table(spark, sf, "events")), "session-files")
    sessions = session_count(stream, "5 minutes", "user_id")
    return plain(_result(sessions, "session-batches", ["session_start", "user_id"])[0])


@query(
    """WITH timely AS (SELECT * FROM events WHERE event_id % 20 <> 0),
    windows AS (
      SELECT time_bucket(INTERVAL '1 hour', ts) AS w, event_type, count(*) AS n FROM timely
      WHERE time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour'
        <= (SELECT max(ts) - INTERVAL 5 SECOND FROM timely)
      GROUP BY ALL)
    SELECT (SELECT count(*) FROM windows) AS n_windows,
      (SELECT CAST(sum(n) AS BIGINT) FROM windows) AS n_trips,
      (SELECT count(*) FROM (SELECT DISTINCT time_bucket(INTERVAL '1 hour', ts), event_type
        FROM events WHERE event_id % 20 = 0)) AS n_late"""
)
def stream_late_rows(spark, sf):
    # Every twentieth event arrives last, with a time long before all others.
    events = table(spark, sf, "events")
    late = F.col("event_id") % 20 == 0
    planted = events.filter(late).withColumn("ts", F.col("ts") - F.expr("INTERVAL 400 DAYS"))
    counter = LateRows()
    spark.streams.addListener(counter)
    try:
        stream = _in_files(spark, [*_slices(events.filter(~late)), planted], "late-files")
        counted = tumbling_count(stream, "1 hour", "event_type")
        result, query_run = _result(counted, "late", ["window_start", "event_type"])
        # Spark counts what it drops after adding up each task's rows per window and key.
        dropped = counter.total(query_run)
    finally:
        spark.streams.removeListener(counter)
    return result.agg(
        F.count("*").alias("n_windows"),
        F.sum("num_trips").alias("n_trips"),
        F.lit(dropped).cast("bigint").alias("n_late"),
    )


PAGE = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])


@query("SELECT o_orderkey, o_totalprice FROM orders")
def paged_numbers(spark, sf):
    # Files page-1.json, page-2.json, ... until there is no more; executors must share the folder.
    folder = work_folder(spark, "numbered-pages")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    names = write_pages(orders, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for number, name in enumerate(names, 1):
        files.rename(path(f"{folder}/{name}"), path(f"{folder}/page-{number}.json"))
    base = folder if "://" in folder else f"file://{folder}"
    return read_paged(spark, f"{base}/page-{{page}}.json", PAGE, pages_per_task=2)


@query(
    """WITH lines AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity,
        l_returnflag, l_linestatus) - 1 AS line FROM lines)
    SELECT 'root' AS level, l_orderkey, NULL::BIGINT AS line, NULL::BIGINT AS tag, count(*)::VARCHAR AS content
      FROM lines GROUP BY l_orderkey
    UNION ALL SELECT 'root__lines', l_orderkey, line, NULL, CAST(l_linenumber AS VARCHAR) FROM placed
    UNION ALL SELECT 'root__lines__tags', l_orderkey, line, 0, l_returnflag FROM placed
    UNION ALL SELECT 'root__lines__tags', l_orderkey, line, 1, l_linestatus FROM placed"""
)
def nested_tree(spark, sf):
    # Orders with an array of lines, each with an array of tags, as JSON documents.
    tags = F.array("l_returnflag", "l_linestatus").alias("tags")
    line = F.struct("l_linenumber", "l_quantity", tags)
    lines = F.sort_array(F.collect_list(line)).alias("lines")
    documents = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), lines)
    path = work_folder(spark, "tree")
    documents.write.json(path)
    tables = child_tables(spark.read.json(path), ["l_orderkey"])
    columns = {
        "root": (F.lit(None), F.lit(None), "n"),
        "root__lines": (F.col("lines__position"), F.lit(None), "l_linenumber"),
        "root__lines__tags": (F.col("lines__position"), F.col("tags__position"), "value"),
    }
    levels = [
        tables[level].select(
            F.lit(level).alias("level"),
            "l_orderkey",
            line.cast("bigint").alias("line"),
            tag.cast("bigint").alias("tag"),
            F.col(content).cast("string").alias("content"),
        )
        for level, (line, tag, content) in columns.items()
    ]
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


# -- what tables look like ----------------------------------------------------------


@query("SELECT CAST(25 AS BIGINT) AS n_rows, CAST(25 AS BIGINT) AS n_found")
def first_rows(spark, sf):
    # Which rows come first is open; all of them must be rows of the table.
    orders = table(spark, sf, "orders")
    some = head(orders, 25)
    known = some.join(orders.withColumn("known", F.lit(True)), some.columns, "left")
    return known.agg(F.count("*").alias("n_rows"), F.count("known").alias("n_found"))


@query(
    """SELECT 'CREATE TABLE IF NOT EXISTS `copy` (' || chr(10) || string_agg('  `' || column_name || '` '
      || CASE data_type WHEN 'VARCHAR' THEN 'STRING' WHEN 'INTEGER' THEN 'INT' ELSE data_type END,
      ',' || chr(10) ORDER BY column_index) || ',' || chr(10) || '  PRIMARY KEY (`r_regionkey`)' || chr(10)
      || ')' AS ddl
    FROM duckdb_columns() WHERE table_name = 'region'"""
)
def table_ddl(spark, sf):
    region = table(spark, sf, "region")
    ddl = create_table_ddl(region, "copy", ("r_regionkey",))
    return region.limit(1).select(F.lit(ddl).alias("ddl"))


@query("SELECT TRUE AS reads_less, TRUE AS reads_something")
def pruned_share(spark, sf):
    path = work_folder(spark, "pruned")
    events = table(spark, sf, "events").select("ts", "user_id")
    write_partitioned(events, path, day_of="ts", cluster="user_id")
    stored = spark.read.parquet(path)
    day = F.col("ts_day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    part, whole = scan_estimate(stored.filter(day)), scan_estimate(stored)
    answer = events.limit(1)
    return answer.select(F.lit(part < 0.25 * whole).alias("reads_less"), F.lit(part > 0).alias("reads_something"))


# -- rules ------------------------------------------------------------------------


@query(
    """WITH staged AS (
      SELECT CASE WHEN event_id % 7 > 0 THEN event_type END AS taxi_type, value, event_id FROM events)
    SELECT 'staging' AS rules, 'not_null' AS check_name, 'taxi_type' AS column_name,
      count(*) FILTER (taxi_type IS NULL) AS failures FROM staged
    UNION ALL SELECT 'staging', 'not_null', 'pickup_datetime', 0
    UNION ALL SELECT 'staging', 'not_null', 'extracted_at', count(*) FILTER (event_id % 11 = 0) FROM staged
    UNION ALL SELECT 'staging', 'non_negative', 'trip_distance', count(*) FILTER (value < 1) FROM staged
    UNION ALL SELECT 'staging', 'row_count_positive', '', 0
    UNION ALL SELECT 'empty', check_name, column_name, failures FROM (VALUES
      ('not_null', 'taxi_type', 0), ('not_null', 'pickup_datetime', 0), ('not_null', 'extracted_at', 0),
      ('non_negative', 'trip_distance', 0), ('row_count_positive', '', 1)) t(check_name, column_name, failures)
    UNION ALL SELECT 'report', check_name, column_name, failures FROM (VALUES
      ('not_null', 'report_date', 0), ('not_null', 'taxi_type', 1), ('non_negative', 'total_trips', 0),
      ('non_negative', 'total_passengers', 0), ('trips_count_positive', 'total_trips', 0))
      t(check_name, column_name, failures)
    UNION ALL SELECT 'report', 'non_negative', 'total_revenue',
      count(*) FROM (SELECT taxi_type FROM staged GROUP BY taxi_type HAVING sum(value - 5) < 0)
    UNION ALL SELECT 'zones', 'unique', 'location_id', count(*) FROM nation WHERE n_nationkey < 5
    UNION ALL SELECT 'zones', 'not_null', 'location_id', 0
    UNION ALL SELECT 'vendors', 'unique', 'vendor_id', 0
    UNION ALL SELECT 'vendors', 'not_null', 'vendor_id', count(*) FILTER (c_custkey % 9 = 0) FROM customer"""
)
def pipeline_checks(spark, sf):
    # Each rule set over rows with known breaks.
    staged = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 7 > 0, F.col("event_type")).alias("taxi_type"),
        F.col("ts").alias("pickup_datetime"),
        F.when(F.col("event_id") % 11 > 0, F.col("ts")).alias("extracted_at"),
        (F.col("value") - 1).alias("trip_distance"),
        F.col("value"),
    )
    report = staged.groupBy("taxi_type").agg(
        F.max(F.to_date("pickup_datetime")).alias("report_date"),
        F.count("*").alias("total_trips"),
        F.sum(F.col("value") - 5).alias("total_revenue"),
        F.count("*").alias("total_passengers"),
    )
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("location_id"))
    zones = nations.unionByName(nations.filter("location_id < 5"))
    key = F.col("c_custkey")
    vendors = table(spark, sf, "customer").select(F.when(key % 9 > 0, key).alias("vendor_id"))
    sets = (
        ("staging", staged, staging_rules()),
        ("empty", staged.filter("value IS NULL AND value IS NOT NULL"), staging_rules()),
        ("report", report, report_rules()),
        ("zones", zones, zone_rules()),
        ("vendors", vendors, vendor_rules()),
    )
    reports = [check_report(df, rules).withColumn("rules", F.lit(name)) for name, df, rules in sets]
    every = reports[0]
    for part in reports[1:]:
        every = every.unionByName(part)
    return every.select("rules", "check_name", "column_name", "failures")
