"""Batch queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmart.functions import (
    encode_json,
    decode_json,
    format_ride,
    from_epoch_ms,
    epoch_ms,
    as_text,
    parse_time,
    safe_cast,
    safe_int,
    strict_cast,
    surrogate_key,
    trip_duration_minutes,
)
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
    having_count,
    in_interval,
    least_frequent,
    left_lookup,
    longest_trips,
    matched,
    new_rows_only,
    on_date,
    orphans,
    rank_ascending,
    row_count,
    share_of,
    total,
    unmatched,
)
from tripmart.plans import (
    best_zone,
    build_fact,
    conform_fhv,
    daily_report,
    dim_vendors,
    enrich_payment,
    enrich_zones,
    month_total,
    monthly_zone_revenue,
    standardise,
    zone_pickups,
)
from tripmart.plans.rules import fact_rules
from tripmart.plans.staging import with_lineage
from tripmart.quality import (
    accepted_values,
    check_report,
    custom_check,
    enforce_contract,
    freshness,
    non_negative,
    not_null,
    parity,
    positive,
    relationships,
    table_shape,
    unique,
    unique_combination,
)
from tripmart.registry import feeds
from tripmart.registry.base import registry
from tripmart.registry.feeds import plain, table
from tripmart.schemas import FACT, RIDE, payment_lookup
from tripmart.sources import count_from_footers
from tripmart.session import work_folder
from tripmart.tables import SnapshotTable, register_views

QUERIES, ORACLES, query = registry()


# -- zones ------------------------------------------------------------------

_PICKUPS = """
WITH pickups AS (
  SELECT n_name AS zone, count(*) AS pickup_count
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name)
"""


def _customer_zones(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation")
    return table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def _pickups(spark: SparkSession, sf: str) -> DataFrame:
    return zone_pickups(
        table(spark, sf, "orders"), _customer_zones(spark, sf), "o_custkey", "c_custkey", "n_name"
    )


@query(_PICKUPS + "SELECT * FROM pickups ORDER BY pickup_count, zone LIMIT 10")
def zone_rank(spark, sf):
    return rank_ascending(_pickups(spark, sf), "pickup_count", "zone", 10)


@query(_PICKUPS + "SELECT * FROM pickups ORDER BY pickup_count, zone LIMIT 1")
def zone_least(spark, sf):
    return least_frequent(_pickups(spark, sf), "pickup_count", "zone")


@query(
    """SELECT o_orderkey AS zone, count(*) AS pickup_count
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY o_orderkey HAVING count(*) = 1"""
)
def zone_singletons(spark, sf):
    counts = zone_pickups(
        table(spark, sf, "lineitem"),
        table(spark, sf, "orders"),
        "l_orderkey",
        "o_orderkey",
        "o_orderkey",
    )
    return having_count(counts, "pickup_count", 1)


@query("SELECT CAST(0 AS BIGINT) AS rows_that_differ")
def zone_parity(spark, sf):
    end = uuid.uuid4().hex
    register_views(
        {
            f"parity_trips_{end}": table(spark, sf, "orders"),
            f"parity_zones_{end}": _customer_zones(spark, sf),
        }
    )
    by_sql = spark.sql(
        f"""SELECT n_name AS zone, count(*) AS pickup_count FROM parity_trips_{end}
        JOIN parity_zones_{end} ON o_custkey = c_custkey GROUP BY n_name"""
    )
    return row_count(parity(_pickups(spark, sf), by_sql), "rows_that_differ")


@query(
    """SELECT o_custkey, 'left' AS only_in, count(*) AS n_rows FROM orders
      WHERE o_orderstatus = 'F' GROUP BY o_custkey
    UNION ALL
    SELECT o_custkey, 'right', count(*) FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey"""
)
def known_differences(spark, sf):
    # Finished orders are only on one side, pending ones twice on the other.
    orders = table(spark, sf, "orders")
    twice = orders.unionByName(orders.filter("o_orderstatus = 'P'"))
    left = orders.select("o_custkey", "o_orderstatus")
    right = twice.filter("o_orderstatus <> 'F'").select("o_custkey", "o_orderstatus")
    differing = parity(left, right)
    return differing.groupBy("o_custkey", "only_in").agg(total("n_rows").alias("n_rows"))


# -- filters and single-table aggregates -------------------------------------


@query(
    """SELECT o_orderstatus, count(*) AS n FROM orders
    WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03' GROUP BY o_orderstatus"""
)
def trips_on_date(spark, sf):
    orders = table(spark, sf, "orders").filter(on_date("o_orderdate", "1998-10-03"))
    return count_by(orders, "o_orderstatus")


@query(
    f"""WITH {feeds.RAW_CTE}
    SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
      date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 3600.0 AS trip_hours
    FROM (SELECT tpep_pickup_datetime, tpep_dropoff_datetime FROM raw_yellow
      UNION ALL SELECT lpep_pickup_datetime, lpep_dropoff_datetime FROM raw_green)
    ORDER BY trip_hours DESC NULLS LAST, tpep_pickup_datetime, tpep_dropoff_datetime LIMIT 5"""
)
def longest_gap(spark, sf):
    yellow, green = (
        feed(spark, sf).select(f"{p}_pickup_datetime", f"{p}_dropoff_datetime")
        for feed, p in ((feeds.raw_yellow, "tpep"), (feeds.raw_green, "lpep"))
    )
    return longest_trips(
        yellow.union(green), 5, tie_break=["tpep_pickup_datetime"]
    ).select("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_hours")


@query("SELECT min(ts) AS first_at, max(ts) AS last_at FROM events")
def event_span(spark, sf):
    return date_span(table(spark, sf, "events"), "ts")


@query(
    """SELECT
      round(CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) / count(*), 9)
        AS purchase_share,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
      count(DISTINCT user_id) AS n_users, count(value) AS n_values
    FROM events"""
)
def share_and_total(spark, sf):
    facts = table(spark, sf, "events").agg(
        F.round(share_of(F.col("event_type") == "purchase"), 9).alias("purchase_share"),
        total(F.col("value").cast("decimal(18,2)")).alias("total_value"),
        count_distinct("user_id").alias("n_users"),
        count_non_null("value").alias("n_values"),
    )
    return plain(facts)


@query(
    """SELECT count(*) AS total_count, count(*) FILTER (l_quantity > 5) AS matching_count
    FROM lineitem"""
)
def count_if_far(spark, sf):
    return conditional_count(table(spark, sf, "lineitem"), F.col("l_quantity") > 5)


@query("SELECT count(*) AS n FROM lineitem WHERE l_tax = 0")
def zero_fares(spark, sf):
    return row_count(table(spark, sf, "lineitem").filter("l_tax = 0"))


@query("SELECT c_mktsegment AS name, count(*) AS player_count FROM customer GROUP BY 1")
def name_counts(spark, sf):
    customers = table(spark, sf, "customer")
    return count_by(customers, F.col("c_mktsegment").alias("name"), name="player_count")


@query("SELECT count(DISTINCT l_suppkey) AS n_zones FROM lineitem")
def distinct_zones(spark, sf):
    return table(spark, sf, "lineitem").agg(count_distinct("l_suppkey").alias("n_zones"))


@query("SELECT count(*) AS n FROM lineitem")
def metadata_count(spark, sf):
    return count_from_footers(spark, f"{sf}/lineitem.parquet")


@query("SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape(spark, sf):
    return table_shape(table(spark, sf, "lineitem"))


@query(
    """SELECT o_custkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'"""
)
def sampled_month(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate")
    return dev_sample(orders, True, "1997-01-01", "1997-02-01", "o_orderdate")


@query(
    """SELECT DISTINCT o_orderpriority FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-15'"""
)
def distinct_between(spark, sf):
    wanted = between_dates_inclusive("o_orderdate", "1998-03-01", "1998-03-15")
    return table(spark, sf, "orders").filter(wanted).select("o_orderpriority").distinct()


@query(
    """SELECT event_id, ts FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')"""
)
def newer_than_target(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return new_rows_only(events, events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), "ts")


# -- conforming ---------------------------------------------------------------


@query(
    f"""WITH {feeds.UNION_CTE}
    SELECT * REPLACE ({feeds.as_doubles(*feeds.MONEY_LIST)}) FROM unioned"""
)
def conform_union(spark, sf):
    return plain(feeds.unioned(spark, sf))


@query(
    """SELECT 'B' || l_suppkey AS dispatching_base_num, l_shipdate AS pickup_datetime,
      l_shipdate + to_hours(l_linenumber) AS dropoff_datetime,
      l_suppkey AS pickup_location_id, l_partkey AS dropoff_location_id
    FROM lineitem WHERE l_quantity > 2"""
)
def conform_for_hire(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_quantity > 2 THEN 'B' || l_suppkey END AS dispatching_base_num",
        "l_shipdate AS pickup_datetime",
        "timestampadd(HOUR, l_linenumber, l_shipdate) AS dropoff_datetime",
        "l_suppkey AS PUlocationID",
        "l_partkey AS DOlocationID",
    )
    return conform_fhv(raw)


@query(
    f"""WITH {feeds.RAW_CTE},
    ingested AS (
      SELECT vendorid AS vendor_id, ratecodeid AS ratecode_id, total_amount, 'yellow' AS taxi_type
      FROM raw_yellow
      UNION ALL
      SELECT vendorid, ratecodeid, total_amount, 'green' FROM raw_green)
    SELECT taxi_type, vendor_id, ratecode_id, count(*) AS n,
      CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM ingested GROUP BY taxi_type, vendor_id, ratecode_id"""
)
def standardise_feeds(spark, sf):
    headers = {"vendorid": "VendorID", "ratecodeid": "RatecodeID"}
    kept = ["vendor_id", "ratecode_id", "total_amount"]
    both = [
        with_lineage(standardise(raw.withColumnsRenamed(headers), columns=kept), kind)
        for kind, raw in (
            ("yellow", feeds.raw_yellow(spark, sf)),
            ("green", feeds.raw_green(spark, sf)),
        )
    ]
    ingested = concat_all(spark, both, both[0].schema)
    grouped = ingested.groupBy("taxi_type", "vendor_id", "ratecode_id")
    amount = total(F.col("total_amount").cast("decimal(18,2)"))
    return plain(grouped.agg(F.count("*").alias("n"), amount.alias("amount")))


@query(
    r"""WITH texts AS (
      SELECT event_id, event_type,
        CASE event_type WHEN 'error' THEN 'n/a' WHEN 'view' THEN NULL
          ELSE CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) / 2.0 AS VARCHAR) END AS half,
        json_extract_string(props, '$.k') AS k
      FROM events)
    SELECT event_id, CAST(round(TRY_CAST(half AS DOUBLE)) AS INTEGER) AS rounded,
      TRY_CAST(half AS DOUBLE) AS number, CAST(k AS INTEGER) AS whole
    FROM texts"""
)
def safe_cast_props(spark, sf):
    k = F.get_json_object("props", "$.k")
    half = (
        F.when(F.col("event_type") == "error", "n/a")
        .when(F.col("event_type") == "view", F.lit(None))
        .otherwise((k.cast("int") / F.lit(2.0)).cast("string"))
    )
    texts = table(spark, sf, "events").select("event_id", half.alias("half"), k.alias("k"))
    return texts.select(
        "event_id",
        safe_int("half").alias("rounded"),
        safe_cast("half", "double").alias("number"),
        strict_cast("k", "int").alias("whole"),
    )


# -- dedupe, enrichment, fact ---------------------------------------------------


@query(
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type
      ORDER BY ts NULLS FIRST, event_id NULLS FIRST) = 1"""
)
def first_event(spark, sf):
    return dedupe_first(table(spark, sf, "events"), ["user_id", "event_type"], ["ts"], ["event_id"])


@query(
    f"""WITH {feeds.TRIPS_CTE}
    SELECT * REPLACE ({feeds.as_doubles(*feeds.MONEY_LIST)}) FROM trips"""
)
def enriched_trips(spark, sf):
    return plain(feeds.trips(spark, sf))


@query(
    f"""WITH {feeds.TRIPS_CTE}
    SELECT coalesce(u.payment_type, 0) AS payment_type,
      coalesce(l.description, 'Unknown') AS payment_type_description, count(*) AS n
    FROM unioned u LEFT JOIN lookup l ON coalesce(u.payment_type, 0) = l.code
    GROUP BY coalesce(u.payment_type, 0), coalesce(l.description, 'Unknown')"""
)
def enrich_lookup(spark, sf):
    found = enrich_payment(feeds.unioned(spark, sf), payment_lookup(spark))
    return count_by(found, "payment_type", "payment_type_description")


@query(
    f"""WITH {feeds.UNION_CTE},{feeds.ZONES_CTE}
    SELECT p.borough AS pickup_borough, p.zone AS pickup_zone, d.borough AS dropoff_borough,
      d.zone AS dropoff_zone, count(*) AS n
    FROM unioned u LEFT JOIN zones p ON u.pickup_location_id = p.location_id
    LEFT JOIN zones d ON u.dropoff_location_id = d.location_id
    GROUP BY p.borough, p.zone, d.borough, d.zone"""
)
def role_playing_dims(spark, sf):
    located = enrich_zones(feeds.unioned(spark, sf), feeds.zones(spark, sf))
    return count_by(located, "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


@query(
    """SELECT o_orderkey, o_custkey, c_name, c_mktsegment
    FROM orders LEFT JOIN customer ON o_custkey + 1 = c_custkey"""
)
def customer_lookup(spark, sf):
    # A lookup that grows with the data gets no broadcast hint.
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    take = {"c_name": "c_name", "c_mktsegment": "c_mktsegment"}
    customers = table(spark, sf, "customer")
    return left_lookup(orders, customers, F.col("o_custkey") + 1, "c_custkey", take, limit=0)


@query(
    """SELECT o_orderkey, md5(concat_ws('-', CAST(o_orderkey AS VARCHAR), o_orderstatus,
      coalesce(CAST(nullif(o_custkey % 3, 0) AS VARCHAR), '_dbt_utils_surrogate_key_null_')))
      AS row_key
    FROM orders"""
)
def row_keys(spark, sf):
    part = F.nullif(F.col("o_custkey") % 3, F.lit(0))
    key = surrogate_key(["o_orderkey", "o_orderstatus", part])
    return table(spark, sf, "orders").select("o_orderkey", key.alias("row_key"))


@query(
    """WITH spans AS (
      SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS a, max(ts) AS b
      FROM events GROUP BY user_id, CAST(ts AS DATE))
    SELECT user_id, day, CAST(date_diff('minute', a, b) AS BIGINT) AS minutes FROM spans"""
)
def duration_minutes(spark, sf):
    spans = (
        table(spark, sf, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    )
    return spans.select("user_id", "day", trip_duration_minutes("a", "b").alias("minutes"))


@query(
    f"""WITH {feeds.FACT_CTE}
    SELECT * REPLACE ({feeds.as_doubles(*feeds.MONEY_LIST)}) FROM fact"""
)
def fact_trips(spark, sf):
    return plain(enforce_contract(feeds.fact(spark, sf), FACT))


_MONTHLY_CTE = f"""{feeds.FACT_CTE},
monthly AS (
  SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
    CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month, service_type,
    sum(fare_amount) AS revenue_monthly_fare, sum(extra) AS revenue_monthly_extra,
    sum(mta_tax) AS revenue_monthly_mta_tax, sum(tip_amount) AS revenue_monthly_tip_amount,
    sum(tolls_amount) AS revenue_monthly_tolls_amount,
    sum(ehail_fee) AS revenue_monthly_ehail_fee,
    sum(improvement_surcharge) AS revenue_monthly_improvement_surcharge,
    sum(total_amount) AS revenue_monthly_total_amount,
    count(trip_id) AS total_monthly_trips,
    round(avg(passenger_count), 6) AS avg_monthly_passenger_count,
    round(CAST(sum(trip_distance) AS DOUBLE) / count(trip_distance), 6)
      AS avg_monthly_trip_distance
  FROM fact
  GROUP BY coalesce(fact.pickup_zone, 'Unknown Zone'),
    CAST(date_trunc('month', pickup_datetime) AS DATE), service_type)"""


def _rounded_means(monthly: DataFrame) -> DataFrame:
    means = ["avg_monthly_passenger_count", "avg_monthly_trip_distance"]
    return monthly.withColumns({c: F.round(c, 6) for c in means})


@query(
    f"""WITH {_MONTHLY_CTE}
    SELECT * REPLACE ({feeds.as_doubles(
        "revenue_monthly_fare", "revenue_monthly_extra", "revenue_monthly_mta_tax",
        "revenue_monthly_tip_amount", "revenue_monthly_tolls_amount",
        "revenue_monthly_ehail_fee", "revenue_monthly_improvement_surcharge",
        "revenue_monthly_total_amount")})
    FROM monthly"""
)
def zone_revenue(spark, sf):
    return plain(_rounded_means(monthly_zone_revenue(feeds.fact(spark, sf))))


@query(
    f"""WITH {_MONTHLY_CTE}
    SELECT pickup_zone, CAST(sum(revenue_monthly_total_amount) AS DOUBLE) AS revenue FROM monthly
    WHERE service_type = 'Green' AND year(revenue_month) = 1998
    GROUP BY pickup_zone ORDER BY revenue DESC, pickup_zone LIMIT 1"""
)
def best_green_zone(spark, sf):
    return plain(best_zone(monthly_zone_revenue(feeds.fact(spark, sf)), "Green", 1998))


@query(
    f"""WITH {_MONTHLY_CTE}
    SELECT CAST(sum(total_monthly_trips) AS BIGINT) AS total_trips FROM monthly
    WHERE service_type = 'Green' AND revenue_month = DATE '1998-10-01'"""
)
def month_trips(spark, sf):
    return month_total(monthly_zone_revenue(feeds.fact(spark, sf)), "Green", "1998-10-01")


@query(
    f"""WITH {feeds.FACT_CTE}
    SELECT DISTINCT vendor_id,
      CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'
        WHEN 4 THEN 'Unknown/Other' END AS vendor_name
    FROM fact"""
)
def vendors(spark, sf):
    return dim_vendors(feeds.fact(spark, sf))


@query(f"WITH {feeds.ZONES_CTE} SELECT * FROM zones")
def zone_dimension(spark, sf):
    return feeds.zones(spark, sf)


def _mean(column: str) -> str:
    """Mean of a two-decimal amount, rounded half up to cents in whole numbers."""
    cents = f"CAST(sum(CAST({column} AS DECIMAL(18,2))) * 100 AS BIGINT)"
    return f"((2 * {cents} + count({column})) // (2 * count({column}))) / 100.0"


@query(
    f"""WITH {feeds.RAW_CTE},
    ingested AS (
      SELECT tpep_pickup_datetime AS pickup_datetime, trip_distance, fare_amount, tip_amount,
        total_amount, passenger_count, vendorid, 'yellow' AS taxi_type FROM raw_yellow
      UNION ALL
      SELECT lpep_pickup_datetime, trip_distance, fare_amount, tip_amount, total_amount,
        passenger_count, vendorid, 'green' FROM raw_green)
    SELECT CAST(pickup_datetime AS DATE) AS report_date, taxi_type, count(*) AS total_trips,
      CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
      {_mean('trip_distance')} AS avg_trip_distance,
      {_mean('fare_amount')} AS avg_fare_amount,
      CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
      {_mean('tip_amount')} AS avg_tip_amount,
      count(DISTINCT vendorid) AS unique_vendors
    FROM ingested
    WHERE pickup_datetime >= TIMESTAMP '1997-01-01' AND pickup_datetime < TIMESTAMP '1999-01-01'
    GROUP BY CAST(pickup_datetime AS DATE), taxi_type"""
)
def daily_summary(spark, sf):
    money = ["trip_distance", "fare_amount", "tip_amount", "total_amount"]
    frames = []
    for kind, raw, stamps in (
        ("yellow", feeds.raw_yellow(spark, sf), "tpep"),
        ("green", feeds.raw_green(spark, sf), "lpep"),
    ):
        renamed = raw.withColumnsRenamed(
            {"vendorid": "vendor_id", f"{stamps}_pickup_datetime": "pickup_datetime"}
        ).withColumn("taxi_type", F.lit(kind))
        exact = renamed.withColumns({c: F.col(c).cast("decimal(18,2)") for c in money})
        frames.append(
            exact.select("pickup_datetime", *money, "passenger_count", "vendor_id", "taxi_type")
        )
    return plain(daily_report(frames[0].unionByName(frames[1]), "1997-01-01", "1999-01-01"))


@query(
    """SELECT * FROM events
    WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:30:00'"""
)
def staging_interval(spark, sf):
    wanted = in_interval("ts", "2024-01-05 06:00:00", "2024-01-20 18:30:00")
    return table(spark, sf, "events").filter(wanted)


# -- existence joins and checks ----------------------------------------------------


@query(
    """SELECT l_partkey, count(*) AS n_rows FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25)
    GROUP BY l_partkey"""
)
def orphan_keys(spark, sf):
    large = table(spark, sf, "part").filter("p_size > 25")
    return orphans(table(spark, sf, "lineitem"), "l_partkey", large, "p_partkey")


@query(
    """SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem
        WHERE l_orderkey = o_orderkey AND l_quantity > 45) AS is_matched
    FROM orders"""
)
def match_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    large = table(spark, sf, "lineitem").filter("l_quantity > 45")
    keys = large.select(F.col("l_orderkey").alias("o_orderkey"))
    inside = matched(orders, keys, ["o_orderkey"]).withColumn("is_matched", F.lit(True))
    outside = unmatched(orders, keys, ["o_orderkey"]).withColumn("is_matched", F.lit(False))
    return inside.unionByName(outside)


@query(
    """WITH counts AS (
      SELECT count(*) FILTER (l_shipdate IS NULL) AS a,
        count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS b,
        count(*) FILTER (l_discount <= 0) AS c, count(*) FILTER (l_tax < 0) AS d
      FROM lineitem),
    twice AS (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1),
    pairs AS (
      SELECT l_orderkey, l_linenumber FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
    report AS (
      SELECT 'not_null' AS check_name, 'l_shipdate' AS column_name, a AS failures FROM counts
      UNION ALL SELECT 'accepted_values', 'l_returnflag', b FROM counts
      UNION ALL SELECT 'positive', 'l_discount', c FROM counts
      UNION ALL SELECT 'non_negative', 'l_tax', d FROM counts
      UNION ALL SELECT 'unique', 'l_orderkey', count(*) FROM twice
      UNION ALL SELECT 'unique_combination', 'l_orderkey, l_linenumber', count(*) FROM pairs
      UNION ALL SELECT 'relationships', 'l_suppkey', count(*) FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
      UNION ALL SELECT 'custom', 'row_count_positive', 0)
    SELECT *, failures = 0 AS passed FROM report"""
)
def check_results(spark, sf):
    lines = table(spark, sf, "lineitem")
    register_views({"checked_lines": lines})
    solvent = table(spark, sf, "supplier").filter("s_acctbal > 0")
    return check_report(
        lines,
        [
            not_null("l_shipdate"),
            accepted_values("l_returnflag", ["A", "N"]),
            positive("l_discount"),
            non_negative("l_tax"),
            unique("l_orderkey"),
            unique_combination("l_orderkey", "l_linenumber"),
            relationships("l_suppkey", solvent, "s_suppkey"),
            custom_check("row_count_positive", "SELECT count(*) > 0 FROM checked_lines", 1),
        ],
    )


@query(
    f"""WITH {feeds.FACT_CTE},
    counts AS (
      SELECT count(*) FILTER (trip_id IS NULL) AS a, count(*) FILTER (vendor_id IS NULL) AS b,
        count(*) FILTER (service_type IS NULL) AS c, count(*) FILTER (pickup_datetime IS NULL) AS d,
        count(*) FILTER (total_amount IS NULL) AS e,
        count(*) FILTER (service_type NOT IN ('Green', 'Yellow')) AS f,
        count(*) FILTER (pickup_location_id NOT IN (SELECT location_id FROM zones)) AS g,
        count(*) FILTER (dropoff_location_id NOT IN (SELECT location_id FROM zones)) AS h
      FROM fact),
    report AS (
      SELECT 'unique' AS check_name, 'trip_id' AS column_name, count(*) AS failures
        FROM (SELECT trip_id FROM fact GROUP BY trip_id HAVING count(*) > 1)
      UNION ALL SELECT 'not_null', 'trip_id', a FROM counts
      UNION ALL SELECT 'not_null', 'vendor_id', b FROM counts
      UNION ALL SELECT 'not_null', 'service_type', c FROM counts
      UNION ALL SELECT 'not_null', 'pickup_datetime', d FROM counts
      UNION ALL SELECT 'not_null', 'total_amount', e FROM counts
      UNION ALL SELECT 'accepted_values', 'service_type', f FROM counts
      UNION ALL SELECT 'relationships', 'pickup_location_id', g FROM counts
      UNION ALL SELECT 'relationships', 'dropoff_location_id', h FROM counts)
    SELECT *, failures = 0 AS passed FROM report"""
)
def fact_checks(spark, sf):
    # Several checks look at the fact: it is a table, not computed for each.
    target = SnapshotTable(spark, work_folder(spark, "checked-fact"))
    zones = feeds.zones(spark, sf)
    build_fact(feeds.trips(spark, sf), zones, target)
    return check_report(target.read(), fact_rules(zones))


@query(
    """SELECT max(ts) AS newest_at,
      round(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01 12:00:00')
        / 3600.0, 6) AS age_hours,
      CASE WHEN date_diff('second', date_trunc('second', max(ts)),
        TIMESTAMP '2024-02-01 12:00:00') / 3600.0 > 48 THEN 'error'
        WHEN date_diff('second', date_trunc('second', max(ts)),
        TIMESTAMP '2024-02-01 12:00:00') / 3600.0 > 24 THEN 'warn' ELSE 'pass' END AS state
    FROM events"""
)
def event_freshness(spark, sf):
    report = freshness(
        table(spark, sf, "events"), "ts", F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")
    )
    return report.withColumn("age_hours", F.round("age_hours", 6))


# -- payloads --------------------------------------------------------------------------


@query(
    """SELECT CAST(l_suppkey AS INTEGER) AS "PULocationID", CAST(l_partkey AS INTEGER) AS "DOLocationID",
      nullif(l_quantity, 50) AS trip_distance, l_extendedprice AS total_amount,
      l_shipdate + to_seconds(l_linenumber) AS pickup_at,
      strftime(l_shipdate + to_seconds(l_linenumber), '%Y-%m-%d %H:%M:%S') AS pickup_text
    FROM lineitem"""
)
def json_round_trip(spark, sf):
    rides = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("l_partkey").cast("int").alias("DOLocationID"),
        F.nullif("l_quantity", F.lit(50.0)).alias("trip_distance"),
        F.col("l_extendedprice").alias("total_amount"),
        epoch_ms(F.expr("timestampadd(SECOND, l_linenumber, l_shipdate)")).alias(
            "tpep_pickup_datetime"
        ),
    )
    decoded = decode_json(encode_json(rides), RIDE)
    at = from_epoch_ms("tpep_pickup_datetime")
    text = as_text(at)
    return plain(
        decoded.select(
            "PULocationID",
            "DOLocationID",
            "trip_distance",
            "total_amount",
            parse_time(text).alias("pickup_at"),
            text.alias("pickup_text"),
        )
    )


@query(
    """SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(json_object(
        'o_orderkey', o_orderkey, 'o_custkey', o_custkey, 'status', nullif(o_orderstatus, 'F'),
        'at', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS VARCHAR) AS value
    FROM orders"""
)
def encoded_messages(spark, sf):
    trips = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.col("o_orderdate").alias("at"),
    )
    return encode_json(trips, key="o_custkey")


@query(
    """SELECT o_orderkey, 'Received: PU=' || o_custkey || ', DO=' || o_orderkey || ', distance='
      || CAST(o_custkey % 7 AS DOUBLE) || ', amount=$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
      || ', pickup=' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS line
    FROM orders"""
)
def ride_lines(spark, sf):
    distance = (F.col("o_custkey") % 7).cast("double")
    line = format_ride("o_custkey", "o_orderkey", distance, "o_totalprice", "o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", line.alias("line"))
