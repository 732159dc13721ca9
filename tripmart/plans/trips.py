"""Union, dedupe, enrichment and the fact table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tripmart.functions import default_to, surrogate_key, trip_duration_minutes
from tripmart.operators.aggregates import high_water
from tripmart.operators.dedupe import dedupe_first
from tripmart.operators.joins import left_lookup
from tripmart.operators.sets import union_aligned
from tripmart.quality.contract import enforce_contract
from tripmart.schemas import FACT, MONEY, TRIPS
from tripmart.tables import SnapshotTable, merge, replace

TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]
# The same, with the most selective column first: sorting compares it first.
DEDUPE_KEY = ["pickup_datetime", "pickup_location_id", "vendor_id", "service_type"]


def union_services(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both conformed feeds in one frame of 20 columns.

    Yellow cabs take street hails only (type 1) and charge no e-hail fee.
    """
    yellow_filled = yellow.withColumns(
        {"trip_type": F.lit(1).cast("int"), "ehail_fee": F.lit(0).cast(MONEY)}
    )
    return union_aligned(
        [
            green.withColumn("service_type", F.lit("Green")),
            yellow_filled.withColumn("service_type", F.lit("Yellow")),
        ],
        TRIPS.names,
    )


def enrich_payment(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add the payment description; no code means 0, no match 'Unknown'."""
    code = default_to("payment_type", 0)
    found = left_lookup(
        df, lookup, code, "payment_type", {"payment_type_description": "description"}
    )
    return found.withColumns(
        {
            "payment_type": code,
            "payment_type_description": default_to("payment_type_description", "Unknown"),
        }
    )


def int_trips(unioned: DataFrame, payment_types: DataFrame) -> DataFrame:
    """One row per trip key, with its id and payment description.

    Neither the id nor the lookup changes which row is kept, so rows are
    dropped first and only the kept ones are hashed and joined.
    """
    kept = dedupe_first(unioned, DEDUPE_KEY, ["dropoff_datetime"])
    return enrich_payment(kept, payment_types).withColumn("trip_id", surrogate_key(TRIP_KEY))


def enrich_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough and zone of both ends of a trip; unknown zones stay NULL."""
    for end in ("pickup", "dropoff"):
        df = left_lookup(
            df,
            zones,
            f"{end}_location_id",
            "location_id",
            {f"{end}_borough": "borough", f"{end}_zone": "zone"},
        )
    return df


def fact_rows(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips in the shape of the fact table."""
    located = enrich_zones(trips, zones).withColumn(
        "trip_duration_minutes", trip_duration_minutes("pickup_datetime", "dropoff_datetime")
    )
    extra = [c for c in located.columns if c not in FACT.names]
    return enforce_contract(located.select(*FACT.names, *extra), FACT, allow_new=True)


def build_fact(
    trips: DataFrame | SnapshotTable,
    zones: DataFrame,
    target: SnapshotTable,
    full_refresh: bool = False,
    lookback: dt.timedelta | None = None,
) -> SnapshotTable:
    """Create the fact table, or merge the trips newer than its newest one.

    The newest stamp is read from the newest partition of the table only and
    enters the plan as a constant: it selects the partitions of a trip table
    and is pushed into their scan. ``lookback`` moves it back, for late trips.
    The trip id fixes the pickup time, so the merge looks for known ids only
    in the partitions that receive rows.
    """
    stored = isinstance(trips, SnapshotTable)
    if full_refresh or not target.exists() or target.read().isEmpty():
        replace(target, fact_rows(trips.read() if stored else trips, zones))
        return target
    newest = high_water(target.read_newest("pickup_datetime"), "pickup_datetime")
    if newest is None:
        return target  # stored trips without a time: nothing is known to be newer
    bound = newest - (lookback or dt.timedelta(0))
    source = trips.read_between(bound) if stored else trips
    newer = source.filter(F.col("pickup_datetime") > F.lit(str(bound)).cast("timestamp_ntz"))
    merge(target, fact_rows(newer, zones), ["trip_id"], key_fixes_partition=True, widen=True)
    return target
