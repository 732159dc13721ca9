"""The rules each table has to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.quality.checks import (
    Check,
    accepted_values,
    has_rows,
    non_negative,
    not_null,
    positive_total,
    relationships,
    unique,
    unique_combination,
)
from tripmart.schemas import SERVICE_TYPES


def _key(column: str) -> list[Check]:
    return [unique(column), not_null(column)]


def _filled(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


def payment_rules() -> list[Check]:
    return _key("payment_type")


def trip_rules() -> list[Check]:
    """Enriched trips."""
    return [
        *_key("trip_id"),
        *_filled("vendor_id", "service_type", "pickup_datetime", "total_amount"),
        accepted_values("service_type", SERVICE_TYPES),
    ]


def fact_rules(zones: DataFrame) -> list[Check]:
    """The trip rules, and both zones known."""
    ends = ("pickup_location_id", "dropoff_location_id")
    return [*trip_rules(), *[relationships(c, zones, "location_id") for c in ends]]


def zone_rules() -> list[Check]:
    return _key("location_id")


def vendor_rules() -> list[Check]:
    return _key("vendor_id")


def monthly_rules() -> list[Check]:
    """Monthly revenue per zone and service."""
    keys = ("pickup_zone", "revenue_month", "service_type")
    return [
        unique_combination(*keys),
        *_filled(*keys, "revenue_monthly_total_amount", "total_monthly_trips"),
        accepted_values("service_type", SERVICE_TYPES),
    ]


def staging_rules() -> list[Check]:
    """Staged trips of an interval: it may not be empty."""
    return [
        *_filled("taxi_type", "pickup_datetime", "extracted_at"),
        non_negative("trip_distance"),
        has_rows(),
    ]


def report_rules() -> list[Check]:
    """The daily report."""
    return [
        *_filled("report_date", "taxi_type"),
        *[non_negative(c) for c in ("total_trips", "total_revenue", "total_passengers")],
        positive_total("total_trips", "trips_count_positive"),
    ]
