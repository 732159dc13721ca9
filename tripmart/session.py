"""Session set-up, the shared work folder and size checks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# A lookup side is broadcast only while its estimated size in memory is below this.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
# The estimate of a scan is the size of its files; rows in memory take several times that.
MEMORY_PER_FILE_BYTE = 8

LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "tripmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    large_state: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time, ANSI casts and adaptive execution.

    ``large_state`` keeps the state of streams on disk (RocksDB) and writes
    only its changes at each batch: use it where windows or sessions do not fit
    in the executors' memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Rows of a streaming session are merged within each task before the shuffle.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.ui.enabled": "false",
    }
    if large_state:
        settings.update(LARGE_STATE)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Where that is unset the session must be local (one machine), and a
    temporary folder of this machine is set for the rest of the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tripmart-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame, without running it."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the size estimate for memory is within ``limit``.

    A larger side is left without a hint: Catalyst then shuffles both sides
    and adaptive execution splits skewed partitions at run time.
    """
    return F.broadcast(df) if estimated_bytes(df) * MEMORY_PER_FILE_BYTE <= limit else df
