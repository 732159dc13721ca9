"""Parquet tables whose content is switched by publishing a small manifest.

Parquet folders have no transactions, and a folder cannot be replaced while it
is read. A snapshot table therefore never changes a file: a change writes new
folders, then publishes a manifest naming the folders that make up the table.
Until then readers see the old content; a crash leaves unused folders behind
and nothing else. One writer per table.

    <root>/manifest/00000003.json
    <root>/data/snapshot=<id>/part_from=2024-01-01/*.parquet
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripmart.frames import empty_frame

SNAPSHOT = "snapshot"  # folder level of one write
PART = "part_from"  # first day of the period a partition holds
WHOLE = ""  # the only partition of a table that is not partitioned
NO_TIME = f"{PART}=__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    folders: dict[str, list[str]]  # partition -> folders below <root>/data
    keys: list[str] = field(default_factory=list)
    applied: dict[str, int] = field(default_factory=dict)  # stream -> last batch

    def to_json(self) -> str:
        body = {**self.__dict__, "schema": self.schema.jsonValue()}
        return json.dumps(body, ensure_ascii=True)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        body = json.loads(text)
        return cls(**{**body, "schema": T.StructType.fromJson(body["schema"])})


def partition_start(partition: str) -> dt.date | None:
    """First day of a partition (``None`` where it holds rows without a time)."""
    if partition in (WHOLE, NO_TIME):
        return None
    return dt.date.fromisoformat(partition.split("=", 1)[1])


class SnapshotTable:
    """A table at ``root``, partitioned by day (or month) of ``time`` if given."""

    def __init__(
        self, spark: SparkSession, root: str, time: str | None = None, grain: str = "day"
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.time = time
        self.grain = grain
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- reading ---------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(path)]

    def _versions(self) -> list[str]:
        names = self._names(f"{self.root}/manifest")
        return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The current manifest, or that of a version; ``None`` where there is none (any more)."""
        versions = self._versions()
        if version is not None:
            versions = [n for n in versions if n == f"{version:08d}.json"]
        return self._load(versions[-1]) if versions else None

    def _load(self, name: str) -> Manifest:
        stream = self._fs.open(self._path(f"{self.root}/manifest/{name}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest.from_json(text)

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self, partitions: Iterable[str] | None = None) -> DataFrame:
        """The current rows, or those of some partitions.

        The schema comes from the manifest: no footers are read to find it, and
        files older than a column show it as NULL.
        """
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no table at {self.root}")
        wanted = manifest.folders if partitions is None else partitions
        folders = [f for p in wanted for f in manifest.folders.get(p, [])]
        return self.read_folders(folders, manifest.schema)

    def read_folders(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return empty_frame(self.spark, schema)
        full = schema
        if self.time:
            full = T.StructType([*schema.fields, T.StructField(PART, T.DateType())])
        base = f"{self.root}/data"
        rows = (
            self.spark.read.schema(full)
            .option("basePath", base)
            .parquet(*[f"{base}/{f}" for f in folders])
        )
        return rows.select(*schema.names)

    def read_newest(self, time: str) -> DataFrame:
        """Rows among which the newest stamp is: the newest partition by that time."""
        periods = [p for p in self.manifest().folders if partition_start(p)]
        if self.time != time or not periods:
            return self.read()
        return self.read([max(periods, key=partition_start)])

    def read_between(
        self, start: dt.datetime | None = None, end: dt.datetime | None = None
    ) -> DataFrame:
        """Rows with ``start <= time < end``; partitions outside are not opened."""

        def overlaps(partition: str) -> bool:
            period = self.period(partition)
            if period is None:
                return partition == WHOLE
            return (start is None or period[1] > start) and (end is None or period[0] < end)

        rows = self.read([p for p in self.manifest().folders if overlaps(p)])
        kind = rows.schema[self.time].dataType
        stamp = F.col(self.time)
        if start is not None:
            rows = rows.filter(stamp >= F.lit(str(start)).cast(kind))
        if end is not None:
            rows = rows.filter(stamp < F.lit(str(end)).cast(kind))
        return rows

    def partition_column(self) -> Column:
        """First day of the period a row falls into."""
        day = F.col(self.time).cast("date")
        return F.trunc(day, "month") if self.grain == "month" else day

    def period(self, partition: str) -> tuple[dt.datetime, dt.datetime] | None:
        """Start and end of a partition's period."""
        first = partition_start(partition)
        if first is None:
            return None
        if self.grain == "month":
            following = (first + dt.timedelta(days=31)).replace(day=1)
        else:
            following = first + dt.timedelta(days=1)
        return dt.datetime.combine(first, dt.time()), dt.datetime.combine(following, dt.time())

    # -- changing --------------------------------------------------------

    def write_folder(self, df: DataFrame) -> dict[str, list[str]]:
        """Write rows to a new folder; they are not part of the table yet."""
        reserved = {SNAPSHOT, PART} & set(df.columns)
        if reserved:
            raise ValueError(f"column names used by the table itself: {sorted(reserved)}")
        snapshot = f"{SNAPSHOT}={uuid.uuid4().hex}"
        target = f"{self.root}/data/{snapshot}"
        if self.time:
            dated = df.withColumn(PART, self.partition_column())
            # Adaptive execution gathers small periods in one task and splits
            # large ones, so a hot day is not written by a single task.
            dated.hint("rebalance", PART).write.partitionBy(PART).parquet(target)
            parts = [n for n in self._names(target) if n.startswith(f"{PART}=")]
            return {part: [f"{snapshot}/{part}"] for part in parts}
        df.write.parquet(target)
        has_rows = any(n.endswith(".parquet") for n in self._names(target))
        return {WHOLE: [snapshot]} if has_rows else {}

    def park(self, df: DataFrame) -> DataFrame:
        """Write an intermediate result beside the table and read it back."""
        folder = f"{SNAPSHOT}={uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/data/{folder}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/data/{folder}")

    def publish(self, manifest: Manifest) -> None:
        """Make a manifest the current one."""
        final = self._path(f"{self.root}/manifest/{manifest.version:08d}.json")
        if self._fs.exists(final):
            raise RuntimeError(f"{final.toString()} exists: another writer was faster")
        draft = self._path(f"{self.root}/manifest/.draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.writeBytes(manifest.to_json())
        finally:
            stream.close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"could not publish {final.toString()}")

    def expire(self, keep: int = 2) -> int:
        """Delete folders that the last ``keep`` manifests do not name.

        For the writer to call between its changes: rows written but not yet
        published are in no manifest. A reader must not be slower than ``keep``
        changes.
        """
        versions = self._versions()
        used = {
            folder.split("/", 1)[0]
            for name in versions[-keep:]
            for folders in self._load(name).folders.values()
            for folder in folders
        }
        if not versions:
            return 0
        unused = [n for n in self._names(f"{self.root}/data") if n not in used]
        for name in versions[:-keep]:
            self._fs.delete(self._path(f"{self.root}/manifest/{name}"), False)
        for name in unused:
            self._fs.delete(self._path(f"{self.root}/data/{name}"), True)
        return len(unused)


def create_keyed_table(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    time: str | None = None,
) -> SnapshotTable:
    """Create an empty keyed table if there is none. The sink keeps the keys unique."""
    table = SnapshotTable(spark, root, time)
    if not table.exists():
        table.publish(Manifest(1, schema, {}, list(keys)))
    return table
