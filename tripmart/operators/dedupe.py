"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dedupe_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The first row per key; NULL sorts first and NULL keys form a group.

    Rows equal in ``order`` are ordered by the other columns, so the result
    does not depend on the input order. Only one row per key and task is
    shuffled (window group limit), whatever the size of a group. Rows are sorted
    by the keys as listed: give the most selective one first.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*keys, *order}]
    ranking = Window.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_first() for c in [*order, *tie_break]]
    )
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")
