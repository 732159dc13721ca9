"""Event-time aggregates, for streams and for batches alike."""

from tripmart.streaming.windows import (
    LateRows,
    deduped,
    late_rows,
    running_count,
    session_count,
    tumbling_count,
    tumbling_sum,
    watermarked,
)

__all__ = [
    "LateRows",
    "deduped",
    "late_rows",
    "running_count",
    "session_count",
    "tumbling_count",
    "tumbling_sum",
    "watermarked",
]
