"""Interval runs: ingested trips to a staging table to a daily report table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tripmart.operators.filters import Moment, in_interval
from tripmart.plans.marts import daily_report
from tripmart.plans.rules import report_rules, staging_rules
from tripmart.quality.checks import check_report, require_passed
from tripmart.tables import SnapshotTable, time_interval


def refresh_staging(
    ingested: DataFrame, staging: SnapshotTable, start: Moment, end: Moment
) -> SnapshotTable:
    """Replace the staged trips picked up in ``[start, end)``."""
    kind = ingested.schema["pickup_datetime"].dataType.simpleString()
    rows = ingested.filter(in_interval("pickup_datetime", start, end, kind))
    time_interval(staging, rows, "pickup_datetime", start, end)
    return staging


def refresh_report(
    staging: SnapshotTable, report: SnapshotTable, start: Moment, end: Moment
) -> SnapshotTable:
    """Recompute the report for the days of ``[start, end)``."""
    first, last = (dt.datetime.fromisoformat(str(m)[:10]) for m in (start, end))
    rows = daily_report(staging.read_between(first, last), first.date(), last.date())
    time_interval(report, rows, "report_date", first.date(), last.date())
    return report


def run_interval(
    ingested: DataFrame, staging: SnapshotTable, report: SnapshotTable, start: Moment, end: Moment
) -> DataFrame:
    """Refresh staging and report for ``[start, end)``, each followed by its checks.

    Returns the rows of both check reports; a broken rule stops the run with an error
    before the next table is touched. An interval without trips breaks one.
    """
    first, last = (dt.datetime.fromisoformat(str(m)) for m in (start, end))
    refresh_staging(ingested, staging, start, end)
    staged = require_passed(check_report(staging.read_between(first, last), staging_rules()))
    refresh_report(staging, report, start, end)
    days = (first.date(), last.date())
    reported = require_passed(check_report(report.read_between(*_midnights(days)), report_rules()))
    return staged.unionByName(reported)


def _midnights(days: tuple[dt.date, dt.date]) -> list[dt.datetime]:
    return [dt.datetime.combine(day, dt.time()) for day in days]
