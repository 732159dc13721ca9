"""Parquet and CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripmart.quality.checks import Check, check_report, require_passed

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_parquet(
    spark: SparkSession, *paths: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Parquet files; only the named columns are read."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def count_from_footers(spark: SparkSession, *paths: str) -> DataFrame:
    """Number of rows of Parquet files, from their footers alone.

    Uses a session of its own, in which counting is pushed into the reader.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(*paths).agg(F.count("*").alias("n"))


def read_csv_inferred(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV with a header; types are inferred (this reads the files twice)."""
    return spark.read.csv(list(paths), header=True, inferSchema=True)


def read_csv_typed(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType,
    time_format: str = TIME_FORMAT,
    null_tokens: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """CSV with declared types; all rows, no index column.

    Text such as ``N/A`` is kept unless listed in ``null_tokens``. A gzip file
    is one split: give ``partitions`` to spread its rows for what follows.
    """
    reader = spark.read.schema(schema).options(
        header=True,
        timestampFormat=time_format,
        timestampNTZFormat=time_format,
        mode="FAILFAST",
    )
    df = reader.csv(list(paths))
    if null_tokens:
        texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns(
            {c: F.when(~F.col(c).isin(list(null_tokens)), F.col(c)) for c in texts}
        )
    return df.repartition(partitions) if partitions else df


def load_seed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checks: Sequence[Check] = (),
    null_tokens: Sequence[str] = (),
) -> DataFrame:
    """A CSV lookup table whose checks have passed."""
    seed = read_csv_typed(spark, path, schema=schema, null_tokens=null_tokens)
    if checks:
        require_passed(check_report(seed, checks))
    return seed
