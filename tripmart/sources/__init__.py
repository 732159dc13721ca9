"""Readers: files, monthly feeds, seeds, JDBC, paged JSON, nested JSON, streams."""

from tripmart.sources.files import (
    count_from_footers,
    load_seed,
    read_csv_inferred,
    read_csv_typed,
    read_parquet,
)
from tripmart.sources.jdbc import read_jdbc
from tripmart.sources.months import ingest_months, month_range, read_months
from tripmart.sources.nested import child_tables, explode_children, flatten_structs
from tripmart.sources.paged import PagedJsonSource, read_paged, stream_paged
from tripmart.sources.streams import read_bounded_kafka, read_trip_stream, trip_events
from tripmart.sources.variants import explode_documents, field_kinds, parse_documents, read_documents, shape_of, split_kinds

__all__ = [
    "PagedJsonSource",
    "explode_documents",
    "field_kinds",
    "parse_documents",
    "read_documents",
    "shape_of",
    "split_kinds",
    "stream_paged",
    "count_from_footers",
    "child_tables",
    "explode_children",
    "flatten_structs",
    "load_seed",
    "month_range",
    "read_bounded_kafka",
    "read_csv_inferred",
    "read_csv_typed",
    "read_jdbc",
    "ingest_months",
    "read_months",
    "read_paged",
    "read_parquet",
    "read_trip_stream",
    "trip_events",
]
