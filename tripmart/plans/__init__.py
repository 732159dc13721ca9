"""Trip models: staging, enriched trips, fact, dimensions and reports."""

from tripmart.plans.current import refresh_distinct, refresh_monthly
from tripmart.plans.marts import (
    best_zone,
    daily_report,
    dim_vendors,
    dim_zones,
    month_total,
    monthly_zone_revenue,
    zone_pickups,
)
from tripmart.plans.refresh import refresh_report, refresh_staging, run_interval
from tripmart.plans.staging import conform_fhv, conform_green, conform_yellow, standardise
from tripmart.plans.trips import build_fact, enrich_payment, enrich_zones, fact_rows, int_trips, union_services

__all__ = [
    "best_zone",
    "build_fact",
    "conform_fhv",
    "conform_green",
    "conform_yellow",
    "daily_report",
    "dim_vendors",
    "dim_zones",
    "enrich_payment",
    "enrich_zones",
    "fact_rows",
    "int_trips",
    "month_total",
    "monthly_zone_revenue",
    "refresh_distinct",
    "refresh_monthly",
    "refresh_report",
    "refresh_staging",
    "run_interval",
    "standardise",
    "union_services",
    "zone_pickups",
]
