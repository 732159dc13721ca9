"""Views and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, types as T


def as_view(df: DataFrame, name: str, shared: bool = False) -> DataFrame:
    """Register a view (visible to all sessions if ``shared``)."""
    if shared:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return df


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Register several views at once."""
    for name, df in frames.items():
        as_view(df, name)


def as_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Drop and recreate a catalog table from a frame (its files at ``path`` if given)."""
    writer = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table over files that stay where they are.

    Partition folders (``day=2024-01-01/...``) are registered as they are now; run it
    again for later ones.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=fmt)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def create_table_ddl(
    source: DataFrame | T.StructType, name: str, keys: tuple[str, ...] = ()
) -> str:
    """``CREATE TABLE`` text for a frame's columns."""
    schema = source.schema if isinstance(source, DataFrame) else source
    lines = [f"  `{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields]
    if keys:
        lines.append(f"  PRIMARY KEY ({', '.join(f'`{k}`' for k in keys)})")
    return f"CREATE TABLE IF NOT EXISTS `{name}` (\n" + ",\n".join(lines) + "\n)"
