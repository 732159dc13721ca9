"""Dimensions, monthly and daily reports, and the questions asked of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tripmart.functions import default_to, month_start, vendor_name
from tripmart.operators.aggregates import count_by, count_distinct, count_non_null, total
from tripmart.operators.filters import in_interval
from tripmart.operators.joins import join_zone
from tripmart.operators.ranking import top_windows
from tripmart.operators.sets import distinct_rows

REVENUE_COLUMNS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_ehail_fee": "ehail_fee",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
}


def dim_zones(seed: DataFrame) -> DataFrame:
    """The zone lookup under its dimension names."""
    return seed.select(
        F.col("locationid").alias("location_id"), "borough", "zone", "service_zone"
    ).toDF("location_id", "borough", "zone", "service_zone")


def dim_vendors(fact: DataFrame) -> DataFrame:
    """The vendors that occur in the fact table, with their names."""
    codes = distinct_rows(fact, "vendor_id")
    return codes.withColumn("vendor_name", vendor_name("vendor_id"))


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue, trips and averages per pickup zone, month and service.

    A missing zone is named before grouping, so it shares a group with a zone
    of that name and the three keys stay unique.
    """
    return fact.groupBy(
        default_to("pickup_zone", "Unknown Zone").alias("pickup_zone"),
        month_start("pickup_datetime").alias("revenue_month"),
        "service_type",
    ).agg(
        *[total(source).alias(name) for name, source in REVENUE_COLUMNS.items()],
        count_non_null("trip_id").alias("total_monthly_trips"),
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        F.avg("trip_distance").alias("avg_monthly_trip_distance"),
    )


def best_zone(monthly: DataFrame, service: str, year: int) -> DataFrame:
    """The pickup zone with the highest revenue of a service in a year."""
    of_year = monthly.filter(
        (F.col("service_type") == service)
        & (F.col("revenue_month") >= F.lit(dt.date(year, 1, 1)))
        & (F.col("revenue_month") < F.lit(dt.date(year + 1, 1, 1)))
    )
    revenue = of_year.groupBy("pickup_zone").agg(
        total("revenue_monthly_total_amount").alias("revenue")
    )
    return top_windows(revenue, "revenue", 1, ["pickup_zone"])


def month_total(monthly: DataFrame, service: str, month: str | dt.date) -> DataFrame:
    """Trips of a service in one month, over all zones."""
    wanted = monthly.filter(
        (F.col("service_type") == service)
        & (F.col("revenue_month") == F.lit(str(month)).cast("date"))
    )
    return wanted.agg(total("total_monthly_trips").alias("total_trips"))


def daily_report(trips: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Trips, revenue, averages, passengers and vendors per day and taxi type.

    The days of ``[start, end)``. The bounds are put on the stamp itself, so
    they reach the reader; for whole days this is the same set of rows.
    """
    day = F.col("pickup_datetime").cast("date")
    kind = trips.schema["pickup_datetime"].dataType.simpleString()
    return (
        trips.filter(in_interval("pickup_datetime", str(start)[:10], str(end)[:10], kind))
        .groupBy(day.alias("report_date"), "taxi_type")
        .agg(
            F.count("*").alias("total_trips"),
            total("total_amount").alias("total_revenue"),
            F.round(F.avg("trip_distance"), 2).alias("avg_trip_distance"),
            F.round(F.avg("fare_amount"), 2).alias("avg_fare_amount"),
            total("passenger_count").alias("total_passengers"),
            F.round(F.avg("tip_amount"), 2).alias("avg_tip_amount"),
            count_distinct("vendor_id").alias("unique_vendors"),
        )
        .orderBy("report_date", "taxi_type")
    )


def zone_pickups(
    trips: DataFrame,
    zones: DataFrame,
    trip_key: str = "PULocationID",
    zone_key: str = "LocationID",
    zone_name: str = "Zone",
) -> DataFrame:
    """Number of pickups per zone name (trips without a zone are not counted).

    Trips are counted per zone id before the join, so the join sees one row
    per id and no hot zone.
    """
    per_id = count_by(trips, F.col(trip_key).alias("_zone_id"), name="_n")
    names = zones.select(F.col(zone_key).alias("_id"), F.col(zone_name).alias("_name"))
    named = join_zone(per_id, names, "_zone_id", "_id")
    return named.groupBy(F.col("_name").alias("zone")).agg(total("_n").alias("pickup_count"))
