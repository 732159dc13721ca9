"""Lookup joins and existence joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tripmart.functions.casts import ColumnLike, col
from tripmart.session import BROADCAST_LIMIT_BYTES, broadcast_if_small


def join_zone(
    trips: DataFrame,
    zones: DataFrame,
    trip_key: str = "PULocationID",
    zone_key: str = "LocationID",
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Trips with their zone; trips without one are dropped."""
    side = broadcast_if_small(zones, limit)
    return trips.join(side, trips[trip_key] == side[zone_key], "inner")


def left_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: ColumnLike,
    lookup_key: str,
    take: dict[str, str],
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Add lookup columns (``{new name: lookup column}``); keep every row.

    ``key`` may be an expression over ``df``. The lookup must hold each key
    once. It is broadcast while small; otherwise both sides are shuffled on the
    key and adaptive execution splits a hot key of ``df`` (the outer side).
    """
    side = lookup.select(
        F.col(lookup_key).alias("_key"), *[F.col(c).alias(name) for name, c in take.items()]
    )
    joined = df.join(broadcast_if_small(side, limit), col(key) == F.col("_key"), "left")
    return joined.drop("_key")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys with a value but without a parent, and their row counts.

    Rows are counted per key first, so a hot key reaches the join as one row.
    """
    counts = (
        child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(fk)).agg(F.count("*").alias("n_rows"))
    )
    keys = parent.select(F.col(pk).alias("_pk"))
    return counts.join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``.

    ``right`` is joined as it is: an aggregate between its shuffle and the join
    would keep adaptive execution from splitting a hot key of ``left``.
    """
    return left.join(right.select(*keys), list(keys), "left_semi")


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right`` (or is NULL)."""
    return left.join(right.select(*keys), list(keys), "left_anti")
