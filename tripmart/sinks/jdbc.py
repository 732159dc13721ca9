"""JDBC sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.sources.jdbc import write_options


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batchsize: int = 2000,
    connections: int = 8,
    **more: str,
) -> None:
    """Create or replace a table (``overwrite``) or add rows, in batched inserts.

    Each partition opens a connection, so their number is bounded. The rows are
    shuffled to that number: coalescing would run the whole query in so few tasks.
    """
    df.repartition(connections).write.format("jdbc").options(
        **write_options(url, table, batchsize, **more)
    ).mode(mode).save()
