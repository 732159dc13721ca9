"""Monthly trip files: ``<base>/<type>_tripdata_<yyyy-mm>.parquet``."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, types as T

from tripmart.operators.sets import concat_all
from tripmart.plans.staging import standardise, with_lineage
from tripmart.schemas import INGESTED, TAXI_TYPES
from tripmart.tables import SnapshotTable, append

log = logging.getLogger(__name__)

# Reading a footer is one small job, so many are read at the same time.
FOOTERS_AT_ONCE = 16


def month_range(start: str | dt.date, end: str | dt.date) -> list[str]:
    """The months (``yyyy-mm``) reached by monthly steps from ``start``, before ``end``."""
    first, last = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    months = []
    year, month = first.year, first.month
    # A step keeps the day of the month, or takes the last day of a shorter one.
    while True:
        following = dt.date(year + month // 12, month % 12 + 1, 1)
        day = min(first.day, (following - dt.timedelta(days=1)).day)
        if dt.date(year, month, day) >= last:
            return months
        months.append(f"{year:04d}-{month:02d}")
        year, month = following.year, following.month


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _by_schema(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """One scan per distinct file schema: months differ in their number types."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    for path, schema in zip(paths, schemas, strict=True):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return [spark.read.schema(schema).parquet(*files) for schema, files in groups.values()]


def read_months(
    spark: SparkSession,
    base: str,
    start: str | dt.date,
    end: str | dt.date,
    types: Sequence[str] = tuple(TAXI_TYPES),
    on_missing: str = "fail",
) -> DataFrame:
    """Trips of the months of ``[start, end)``, tagged with type and read time.

    A missing file is an error, or with ``on_missing='skip'`` is logged.
    Only the 17 columns kept are read from the files.
    """
    paths = {
        kind: [f"{base}/{kind}_tripdata_{month}.parquet" for month in month_range(start, end)]
        for kind in types
    }
    missing = [p for files in paths.values() for p in files if not _exists(spark, p)]
    if missing and on_missing == "fail":
        raise FileNotFoundError(f"missing trip files: {missing}")
    if missing:
        log.warning("skipped missing trip files: %s", missing)
    kinds = {f.name: f.dataType for f in INGESTED.fields}
    frames = []
    for kind, files in paths.items():
        for df in _by_schema(spark, [p for p in files if p not in missing]):
            trips = standardise(df)
            typed = trips.select(*[trips[c].cast(kinds[c]).alias(c) for c in trips.columns])
            frames.append(with_lineage(typed, kind).select(*INGESTED.names))
    return concat_all(spark, frames, INGESTED)


def ingest_months(
    spark: SparkSession,
    base: str,
    ingested: SnapshotTable,
    start: str | dt.date,
    end: str | dt.date,
    types: Sequence[str] = tuple(TAXI_TYPES),
) -> SnapshotTable:
    """Append the monthly files of ``[start, end)`` to the table of ingested trips."""
    append(ingested, read_months(spark, base, start, end, types))
    return ingested
