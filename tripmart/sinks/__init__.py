"""Writers: files, partitioned layouts, JDBC, streams."""

from tripmart.sinks.files import (
    interleaved,
    write_clustered,
    write_day,
    write_layout,
    write_pages,
    write_parquet,
    write_partitioned,
)
from tripmart.sinks.jdbc import write_jdbc
from tripmart.sinks.streams import (
    append_sink,
    console_sink,
    jdbc_sink,
    memory_sink,
    publish_stream,
    to_kafka,
    upsert_sink,
)
from tripmart.sinks.windows import CorrectedCounts, merge_sessions, session_sink

__all__ = [
    "CorrectedCounts",
    "append_sink",
    "console_sink",
    "interleaved",
    "jdbc_sink",
    "memory_sink",
    "merge_sessions",
    "publish_stream",
    "session_sink",
    "to_kafka",
    "upsert_sink",
    "write_clustered",
    "write_day",
    "write_jdbc",
    "write_layout",
    "write_pages",
    "write_parquet",
    "write_partitioned",
]
