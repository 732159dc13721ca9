"""Materialisation: views, tables and snapshot tables with replace semantics."""

from tripmart.tables.catalog import as_table, as_view, create_table_ddl, register_external, register_views
from tripmart.tables.snapshot import SnapshotTable, create_keyed_table
from tripmart.tables.strategies import (
    append,
    delete_insert,
    has_applied,
    merge,
    replace,
    replace_partitions,
    swap,
    time_interval,
)
from tripmart.tables.widening import common_type

__all__ = [
    "SnapshotTable",
    "append",
    "as_table",
    "as_view",
    "common_type",
    "create_keyed_table",
    "create_table_ddl",
    "delete_insert",
    "has_applied",
    "merge",
    "register_external",
    "register_views",
    "replace",
    "replace_partitions",
    "swap",
    "time_interval",
]
