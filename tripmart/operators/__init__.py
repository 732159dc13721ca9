"""DataFrame operators: filters, joins, aggregates, ranking, set operations."""

from tripmart.operators.aggregates import (
    conditional_count,
    count_by,
    count_distinct,
    count_non_null,
    date_span,
    high_water,
    row_count,
    share_of,
    total,
)
from tripmart.operators.dedupe import dedupe_first
from tripmart.operators.distinct import distinct_rollup, distinct_sketches, united
from tripmart.operators.filters import (
    between_dates_inclusive,
    dev_sample,
    having_count,
    in_interval,
    new_rows_only,
    on_date,
    require_not_null,
)
from tripmart.operators.joins import join_zone, left_lookup, matched, orphans, unmatched
from tripmart.operators.ranking import (
    head,
    least_frequent,
    longest_trips,
    rank_ascending,
    top_windows,
)
from tripmart.operators.sets import concat_all, distinct_rows, union_aligned

__all__ = [
    "between_dates_inclusive",
    "concat_all",
    "conditional_count",
    "count_by",
    "count_distinct",
    "count_non_null",
    "date_span",
    "dedupe_first",
    "dev_sample",
    "distinct_rollup",
    "distinct_rows",
    "distinct_sketches",
    "having_count",
    "head",
    "high_water",
    "in_interval",
    "join_zone",
    "least_frequent",
    "left_lookup",
    "longest_trips",
    "matched",
    "new_rows_only",
    "on_date",
    "orphans",
    "rank_ascending",
    "require_not_null",
    "row_count",
    "share_of",
    "top_windows",
    "total",
    "union_aligned",
    "united",
    "unmatched",
]
