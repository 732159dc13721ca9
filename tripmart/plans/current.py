"""Reports that follow their source: only what changed since the last run is computed again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tripmart.operators.distinct import distinct_sketches
from tripmart.operators.filters import Moment
from tripmart.plans.marts import monthly_zone_revenue
from tripmart.tables import SnapshotTable, replace_partitions, time_interval
from tripmart.tables.snapshot import NO_TIME, PART, Manifest, partition_start


def month_partition(partition: str) -> str:
    """The partition by month that holds a partition by day or month."""
    first = partition_start(partition)
    return NO_TIME if first is None else f"{PART}={first.replace(day=1)}"


def changed_months(before: Manifest | None, now: Manifest) -> set[str]:
    """Months whose folders differ between two manifests of a table; all of both without the first one."""
    old = before.folders if before else {}
    names = set(old) | set(now.folders)
    return {month_partition(p) for p in names if old.get(p) != now.folders.get(p)}


def months_of(fact: SnapshotTable, months: set[str]) -> DataFrame:
    """The rows of some months of a table; the partitions of other months are not opened."""
    now = fact.manifest()
    folders = [f for p, of in now.folders.items() if month_partition(p) in months for f in of]
    return fact.read_folders(folders, now.schema)


def refresh_monthly(fact: SnapshotTable, report: SnapshotTable) -> set[str]:
    """Bring the monthly revenue up to date with the fact; returns the months computed again.

    The report remembers the version of the fact it was made from. Files of a table never
    change, so a month whose folders are the same in both versions has the same rows, and
    its report is kept as it is, unread. Late trips, corrections, deletions and a rebuilt fact all
    show as changed folders. Where that version has expired, every month is computed. A fact without a new version changes nothing.
    """
    if fact.time is None or report.time != "revenue_month" or report.grain != "month":
        raise ValueError("the fact is to be partitioned by its pickup time, the report by revenue_month")
    now = fact.manifest()
    if now is None:
        raise FileNotFoundError(f"no table at {fact.root}")
    stored = report.manifest()
    seen = stored.applied.get(fact.root) if stored else None
    if seen == now.version:
        return set()
    before = fact.manifest(seen) if seen is not None else None
    months = changed_months(before, now)
    if before is None and stored:
        months |= set(stored.folders)
    rows = monthly_zone_revenue(months_of(fact, months))
    replace_partitions(report, rows, sorted(months), batch=(fact.root, now.version))
    return months


def refresh_distinct(
    source: SnapshotTable, sketches: SnapshotTable, start: Moment, end: Moment, column: str, keys: tuple[str, ...]
) -> SnapshotTable:
    """Recompute the daily sketches of a column for the days of ``[start, end)``.

    ``sketches`` is partitioned by ``day``. ``distinct_rollup`` counts any longer period
    from them, without the source.
    """
    first, last = (dt.datetime.fromisoformat(str(m)[:10]) for m in (start, end))
    rows = source.read_between(first, last).withColumn("day", F.col(source.time).cast("date"))
    time_interval(sketches, distinct_sketches(rows, ("day", *keys), column), "day", first.date(), last.date())
    return sketches
