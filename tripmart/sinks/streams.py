"""Stream sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tripmart.functions import encode_json
from tripmart.sinks.jdbc import write_jdbc
from tripmart.tables import SnapshotTable, append, merge


# Versions of a table that its stream leaves for slow readers.
KEEP_VERSIONS = 8


def _writer(df: DataFrame, checkpoint: str, output_mode: str, drain: bool) -> DataStreamWriter:
    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if drain else writer


def upsert_sink(
    df: DataFrame,
    table: SnapshotTable,
    checkpoint: str,
    keys: Sequence[str] | None = None,
    output_mode: str = "append",
    drain: bool = True,
) -> StreamingQuery:
    """Merge each micro-batch into a keyed table.

    The table's manifest records the last batch, published together with its
    rows: a batch repeated after a failure changes nothing. ``drain`` stops
    when all input present at the start is read. Versions of the table before the last
    ``KEEP_VERSIONS`` are removed, so a stream leaves no more behind the longer it runs.
    """

    def apply(batch: DataFrame, number: int) -> None:
        merge(table, batch, keys, batch=(checkpoint, number))
        table.expire(KEEP_VERSIONS)

    return _writer(df, checkpoint, output_mode, drain).foreachBatch(apply).start()


def append_sink(
    df: DataFrame, target: SnapshotTable | str, checkpoint: str, drain: bool = True
) -> StreamingQuery:
    """Insert each row once, into a table or (given a path) into Parquet files.

    A table packs a partition's folders when they become many and keeps its last
    ``KEEP_VERSIONS`` versions. For an endless stream into few partitions prefer files:
    packing reads the partition again, Spark's file sink does not.
    """
    if isinstance(target, str):
        writer = _writer(df, checkpoint, "append", drain).format("parquet")
        return writer.option("path", target).start()

    def apply(batch: DataFrame, number: int) -> None:
        append(target, batch, batch=(checkpoint, number))
        target.expire(KEEP_VERSIONS)

    return _writer(df, checkpoint, "append", drain).foreachBatch(apply).start()


def jdbc_sink(
    df: DataFrame, url: str, table: str, checkpoint: str, drain: bool = True, **more: str
) -> StreamingQuery:
    """Insert each micro-batch into a database table.

    A batch repeated after a failure is inserted again: give the table a key,
    or insert into one that is merged later.
    """

    def apply(batch: DataFrame, number: int) -> None:
        write_jdbc(batch, url, table, **more)

    return _writer(df, checkpoint, "append", drain).foreachBatch(apply).start()


def console_sink(df: DataFrame, n: int = 10) -> StreamingQuery:
    """Print the first ``n`` rows; ends when the input present is read."""
    return (
        df.limit(n)
        .writeStream.format("console")
        .option("numRows", n)
        .option("truncate", "false")
        .trigger(availableNow=True)
        .start()
    )


def memory_sink(df: DataFrame, name: str, n: int = 10) -> StreamingQuery:
    """Keep the first ``n`` rows of a stream in a table of the driver, to be looked at as ``spark.table(name)``.

    Ends when the input present is read. The driver holds ``n`` rows, whatever the stream brings.
    """
    writer = df.limit(n).writeStream.format("memory").queryName(name)
    return writer.trigger(availableNow=True).start()


def _topic(servers: str, topic: str, more: Mapping[str, str] | None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(more or {})}


def to_kafka(
    df: DataFrame,
    servers: str,
    topic: str,
    columns: Sequence[str] | None = None,
    key: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Publish rows as JSON (needs the Kafka connector).

    A key column decides the partition of a message; without one they are
    spread evenly, which a hot key would not be.
    """
    messages = encode_json(df, columns, key)
    messages.write.format("kafka").options(**_topic(servers, topic, options)).save()


def publish_stream(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    columns: Sequence[str] | None = None,
    drain: bool = True,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Publish a stream as JSON (needs the Kafka connector)."""
    out = _writer(encode_json(df, columns), checkpoint, "append", drain).format("kafka")
    return out.options(**_topic(servers, topic, options)).start()
