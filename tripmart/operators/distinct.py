"""Exact sets of numbers as bitmaps: made once per period, united for longer periods.

``count(DISTINCT)`` of a month does not follow from those of its days. Sets do: a set is cut
into buckets of 32,768 neighbouring numbers; a bucket with few numbers lists them, a fuller one
is a bitmap of 4 kB. Uniting sets is an ``or`` of their bitmaps, with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tripmart.functions.casts import ColumnLike, col

# Up to so many numbers a list is smaller than a bitmap. The limit changes the form, never the set.
LISTED = 512
WHOLE_NUMBERS = ("byte", "short", "integer", "long")


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Per key and bucket, the different values of a whole-number column (NULL left out).

    Columns: the keys, ``bucket``, ``listed`` and ``bitmap`` (one of them NULL). Equal values are
    dropped within each task before they are shuffled.
    """
    kind = df.schema[column].dataType.typeName()
    if kind not in WHOLE_NUMBERS:
        raise ValueError(f"{column} is no whole number but {kind}")
    value = F.col(column)
    places = (
        df.filter(value.isNotNull())
        .select(*keys, F.bitmap_bucket_number(value).alias("bucket"), F.bitmap_bit_position(value).alias("_place"))
        .distinct()
    )
    few = F.col("_n") <= LISTED
    return (
        places.groupBy(*keys, "bucket")
        .agg(
            F.count("*").alias("_n"),
            F.collect_list(F.col("_place").cast("int")).alias("_listed"),
            F.bitmap_construct_agg("_place").alias("_bitmap"),
        )
        .select(
            *keys,
            "bucket",
            F.when(few, F.sort_array("_listed")).alias("listed"),
            F.when(~few, F.col("_bitmap")).alias("bitmap"),
        )
    )


def united(sketches: DataFrame, keys: Sequence[ColumnLike]) -> DataFrame:
    """One bitmap per key and bucket: the union of all sets of the key."""
    by: list[Column] = [col(k) for k in keys]
    names = sketches.select(*by).columns
    rows = sketches.select(*by, "bucket", "listed", "bitmap")
    full = rows.filter("bitmap IS NOT NULL").select(*names, "bucket", "bitmap")
    listed = (
        rows.filter("listed IS NOT NULL")
        .select(*names, "bucket", F.explode("listed").alias("_place"))
        .groupBy(*names, "bucket")
        .agg(F.bitmap_construct_agg(F.col("_place").cast("long")).alias("bitmap"))
    )
    return full.unionByName(listed).groupBy(*names, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_rollup(sketches: DataFrame, keys: Sequence[ColumnLike], name: str = "n_distinct") -> DataFrame:
    """Exact number of different values per key, from sketches of any finer grain."""
    bitmaps = united(sketches, keys)
    names = [c for c in bitmaps.columns if c not in ("bucket", "bitmap")]
    return bitmaps.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
