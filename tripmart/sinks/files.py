"""File sinks."""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def write_parquet(df: DataFrame, path: str, n_files: int | None = None, mode: str = "error") -> None:
    """Write Parquet, in ``n_files`` files of equal size if given."""
    out = df.repartition(n_files) if n_files else df
    out.write.mode(mode).parquet(path)


def write_day(df: DataFrame, path: str, day: str | dt.date) -> None:
    """Write the output of one run day; a repeat replaces that day only."""
    (
        df.withColumn("day", F.lit(str(day)).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


PAGE_ROWS = 10_000


def write_pages(df: DataFrame, path: str, n_rows: int = PAGE_ROWS, least: int = 8) -> list[str]:
    """Write JSON files of at most ``n_rows`` records, one a line; the names of those that hold any.

    A larger table gives more files, not longer ones, so whoever reads a file whole holds a bounded part of the
    table. A small table is spread over ``least`` files; the rows are counted for that.
    """
    n_rows = max(1, min(n_rows, df.count() // least))
    # Every record names its columns, those that are NULL too.
    df.write.option("maxRecordsPerFile", n_rows).option("ignoreNullFields", "false").json(path)
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).listStatus(folder)
    # Spark's first task writes a file even if it has no rows.
    names = [s.getPath().getName() for s in files if s.getLen() > 0]
    return sorted(n for n in names if n.startswith("part-"))


def write_layout(df: DataFrame, root: str, schema: str, table: str, fmt: str = "parquet") -> str:
    """Write below ``<root>/<schema>/<table>.<format>``."""
    path = f"{root}/{schema}/{table}.{fmt}"
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def write_partitioned(
    df: DataFrame, path: str, day_of: str, cluster: str, mode: str = "error"
) -> None:
    """Folders by the day of a stamp, rows inside ordered by a key.

    The partition column is ``<day_of>_day``. Days are gathered by a rebalance,
    which splits a day too large for one task; the order gives each row group
    a narrow key range to skip by.
    """
    day = f"{day_of}_day"
    (
        df.withColumn(day, F.col(day_of).cast("date"))
        .hint("rebalance", day)
        .sortWithinPartitions(day, cluster)
        .write.mode(mode)
        .partitionBy(day)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A catalog table bucketed by a key: joins on that key need no shuffle of it."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


CODE_BITS = 8


def _number(df: DataFrame, key: str) -> Column:
    """A number that grows with the key: itself, its seconds, or the first six bytes of a text."""
    kind = df.schema[key].dataType.typeName()
    column = F.col(key)
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if kind in ("byte", "short", "integer", "long", "float", "double", "decimal", "boolean"):
        return column.cast("double")
    raise ValueError(f"rows cannot be clustered by {key}: {kind}")


def _quantile(number: Column, bounds: Column, halves: Column) -> Column:
    """How many of the sorted bounds lie below a number, by halving."""

    def narrowed(code: Column, half: Column) -> Column:
        return F.when(F.element_at(bounds, code + half) < number, code + half).otherwise(code)

    return F.aggregate(halves, F.lit(0), narrowed)


def interleaved(df: DataFrame, keys: Sequence[str], bits: int = CODE_BITS) -> Column:
    """Position of a row on a curve that keeps rows near each other that are near in every key.

    Each key is replaced by the number of the quantile it lies in (of ``2 ** bits``, so a skewed key
    uses all of them; NULL counts as the smallest), and the bits of all numbers are taken in turn.
    Quantiles come from one pass over the keys; they fit the driver (255 values a key).
    """
    if not 0 < len(keys) * bits <= 62:
        raise ValueError("between 1 and 62 bits make a position")
    steps = 1 << bits
    shares = [i / steps for i in range(1, steps)]
    numbers = {k: _number(df, k) for k in keys}
    found = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(f"q{i}") for i, n in enumerate(numbers.values())]).first()
    position = F.lit(0).cast("long")
    halves = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    for i, number in enumerate(numbers.values()):
        bounds = F.array(*[F.lit(float(v)) for v in (found[f"q{i}"] or [0.0] * len(shares))])
        code = _quantile(number, bounds, halves).cast("long")
        for b in range(bits):
            bit = F.shiftright(code, b).bitwiseAND(F.lit(1))
            position = position.bitwiseOR(F.shiftleft(bit, b * len(keys) + i))
    return position


def write_clustered(
    df: DataFrame, path: str, keys: Sequence[str], n_files: int | None = None, mode: str = "error", bits: int = CODE_BITS
) -> None:
    """Write rows in the interleaved order of several keys.

    Files and row groups then have narrow ranges of every key, so a filter on any of them skips
    most of the data by its statistics; plain order by the keys does so for the first one only. Rows are
    dealt to ``n_files`` files (or as many as adaptive execution finds fitting) by ranges of the order.
    """
    column = "_position"
    placed = df.withColumn(column, interleaved(df, keys, bits))
    dealt = placed.repartitionByRange(n_files, column) if n_files else placed.repartitionByRange(column)
    dealt.sortWithinPartitions(column).drop(column).write.mode(mode).parquet(path)
