"""Data-quality checks and table inspection."""

from tripmart.quality.checks import (
    CheckFailed,
    accepted_values,
    check_report,
    custom_check,
    freshness,
    non_negative,
    not_null,
    positive,
    relationships,
    require_passed,
    unique,
    unique_combination,
)
from tripmart.quality.contract import enforce_contract
from tripmart.quality.inspect import (
    differing_buckets,
    parity_in_buckets,
    scanned_partitions,
    describe_table,
    file_stats,
    parity,
    partition_sizes,
    scan_estimate,
    table_shape,
)

__all__ = [
    "CheckFailed",
    "differing_buckets",
    "parity_in_buckets",
    "scanned_partitions",
    "accepted_values",
    "check_report",
    "custom_check",
    "describe_table",
    "enforce_contract",
    "file_stats",
    "freshness",
    "non_negative",
    "not_null",
    "parity",
    "partition_sizes",
    "positive",
    "relationships",
    "require_passed",
    "scan_estimate",
    "table_shape",
    "unique",
    "unique_combination",
]
