"""SQL databases over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KeyRange:
    """How to split a read: parallel queries over ranges of a numeric or time key."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_options(
    url: str, source: str, fetchsize: int = 1000, split: KeyRange | None = None, **more: str
) -> dict[str, str]:
    """Reader options; ``source`` is a table name or a SELECT."""
    is_query = source.lstrip().lower().startswith(("select", "with"))
    options = {
        "url": url,
        "fetchsize": str(fetchsize),
        # A split read needs a table expression; the options exclude each other.
        "dbtable": f"({source}) q" if is_query else source,
        **more,
    }
    if split:
        options.update(
            partitionColumn=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=str(split.partitions),
        )
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    source: str,
    fetchsize: int = 1000,
    split: KeyRange | None = None,
    **more: str,
) -> DataFrame:
    """A table or query of a database.

    Without ``split`` one task reads all rows over one connection: split every
    source whose size is not small.
    """
    return spark.read.format("jdbc").options(**read_options(url, source, fetchsize, split, **more)).load()


def write_options(url: str, table: str, batchsize: int = 2000, **more: str) -> Mapping[str, str]:
    """Writer options."""
    return {"url": url, "dbtable": table, "batchsize": str(batchsize), **more}
