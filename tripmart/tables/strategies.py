"""Ways to bring new rows into a snapshot table.

Each one writes the new rows first (they are computed once) and reads them
back for checks and joins; what must leave the table is then found among the
partitions that can hold it, and only those are rewritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace as changed
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F, types as T

from tripmart.operators.filters import in_interval
from tripmart.operators.joins import matched, unmatched
from tripmart.tables.snapshot import NO_TIME, PART, WHOLE, Manifest, SnapshotTable
from tripmart.tables.widening import common_type

# Types of keys whose smallest and largest new value bound the search.
BOUNDED = ("byte", "short", "integer", "long", "date", "string")
# A partition spread over more folders than this is rewritten when touched.
MAX_FOLDERS_PER_PARTITION = 32


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _merged_schema(old: T.StructType, new: T.StructType, widen: bool) -> T.StructType:
    """The table's schema after rows of another one; ``widen`` allows new columns and wider types."""
    known = {f.name: f.dataType for f in old.fields}
    kinds = {f.name: f.dataType for f in new.fields if f.name in known}
    if widen:
        kinds = {name: common_type(known[name], kind) for name, kind in kinds.items()}
    clashes = [name for name, kind in kinds.items() if kind is None or (kind != known[name] and not widen)]
    if clashes:
        raise ValueError(f"columns change their type: {clashes}")
    added = [f for f in new.fields if f.name not in known]
    if added and not widen:
        raise ValueError(f"columns not in the table: {[f.name for f in added]}")
    kept = [T.StructField(f.name, kinds.get(f.name, f.dataType), True) for f in old.fields]
    return T.StructType([*kept, *added])


def _join_folders(*parts: dict[str, list[str]]) -> dict[str, list[str]]:
    result: dict[str, list[str]] = {}
    for part in parts:
        for partition, folders in part.items():
            result.setdefault(partition, []).extend(folders)
    return result


def _next(
    target: SnapshotTable,
    old: Manifest,
    folders: dict[str, list[str]],
    schema: T.StructType,
    batch: tuple[str, int] | None = None,
) -> None:
    applied = {**old.applied, batch[0]: batch[1]} if batch else old.applied
    target.publish(
        changed(old, version=old.version + 1, folders=folders, schema=schema, applied=applied)
    )


def _applied(old: Manifest | None, batch: tuple[str, int] | None) -> bool:
    return bool(old and batch and old.applied.get(batch[0], -1) >= batch[1])


def has_applied(target: SnapshotTable, batch: tuple[str, int] | None) -> bool:
    """Whether a batch (stream, number) is in the table already."""
    return _applied(target.manifest(), batch)


def replace(target: SnapshotTable, rows: DataFrame) -> None:
    """Drop all rows and insert the new ones (also: full refresh)."""
    old = target.manifest() or Manifest(0, T.StructType(), {})
    _next(target, old, target.write_folder(rows), _nullable(rows.schema))


def append(
    target: SnapshotTable,
    rows: DataFrame,
    widen: bool = False,
    batch: tuple[str, int] | None = None,
) -> None:
    """Add rows.

    Existing files are neither read nor rewritten, but for a partition that has come to
    more than ``MAX_FOLDERS_PER_PARTITION`` folders: that one is written anew as one.
    """
    old = target.manifest()
    if _applied(old, batch):
        return
    schema = _nullable(rows.schema)
    old = old or Manifest(0, schema, {})
    schema = _merged_schema(old.schema, schema, widen)
    new = target.write_folder(rows)
    if new or old.version == 0 or schema != old.schema:
        crowded = [p for p in new if len(old.folders.get(p, [])) >= MAX_FOLDERS_PER_PARTITION]
        kept = {p: f for p, f in old.folders.items() if p not in crowded}
        packed = target.write_folder(target.read(crowded)) if crowded else {}
        _next(target, old, _join_folders(kept, packed, new), schema, batch)


def _partition_name(target: SnapshotTable):
    if not target.time:
        return F.lit(WHOLE)
    start = target.partition_column().cast("string")
    return F.coalesce(F.concat(F.lit(f"{PART}="), start), F.lit(NO_TIME))


def _within_bounds(staged: DataFrame, keys: Sequence[str], unique: bool = False):
    """A condition that every row with a key of ``staged`` meets, as constants.

    The same pass over the keys finds a key that occurs more than once, which is an error if they
    are to be ``unique`` (keys with a NULL are never equal).
    """
    plain = [k for k in keys if staged.schema[k].dataType.typeName() in BOUNDED]
    found = staged
    times = F.lit(1)
    if unique:
        found = staged.groupBy(*keys).agg(F.count("*").alias("_times"))
        whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
        times = F.when(whole, F.col("_times"))
    bounds = [f(k) for k in plain for f in (F.min, F.max)]
    row = found.agg(F.max(times).alias("times"), *[b.alias(f"b{i}") for i, b in enumerate(bounds)]).first()
    if unique and (row["times"] or 0) > 1:
        raise ValueError(f"merge source holds a key more than once: {list(keys)}")
    condition = F.lit(True)
    for i, k in enumerate(plain):
        low, high = row[f"b{2 * i}"], row[f"b{2 * i + 1}"]
        if low is not None:
            kind = staged.schema[k].dataType
            condition &= F.col(k).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return condition


def _put(
    target: SnapshotTable,
    rows: DataFrame,
    keys: Sequence[str],
    unique: bool,
    key_fixes_partition: bool,
    widen: bool,
    batch: tuple[str, int] | None,
) -> None:
    old = target.manifest()
    if _applied(old, batch):
        return
    schema = _nullable(rows.schema)
    old = old or Manifest(0, schema, {}, list(keys))
    schema = _merged_schema(old.schema, schema, widen)
    new = target.write_folder(rows)
    if not new:
        if old.version == 0 or schema != old.schema:
            _next(target, old, old.folders, schema, batch)
        return
    staged = target.read_folders([f for fs in new.values() for f in fs], _nullable(rows.schema))
    # With the time in the key, or a key made from it, equal keys share a partition.
    fixed = key_fixes_partition or target.time in keys
    candidates = [p for p in old.folders if p in new or not fixed]
    bounds = _within_bounds(staged, keys, unique) if unique or (candidates and not fixed) else None
    hit: set[str] = set()
    if candidates and not unique:
        # One row per key, written so that the joins below have no aggregate in
        # the way of splitting a hot key of the table.
        staged = target.park(staged.select(*keys).distinct())
    if candidates:
        # Only the keys and the time are scanned here. The result is a list of
        # partitions: one value per day at most.
        columns = [*keys, *([target.time] if target.time not in (None, *keys) else [])]
        stored = target.read(candidates).select(*columns)
        if not fixed:
            # Row groups whose keys lie outside the new ones are skipped by their statistics.
            stored = stored.filter(bounds)
        found = matched(stored, staged, keys)
        hit = {r["p"] for r in found.select(_partition_name(target).alias("p")).distinct().collect()}
        hit |= {p for p in candidates if p in new and len(old.folders[p]) > MAX_FOLDERS_PER_PARTITION}
    kept = {p: f for p, f in old.folders.items() if p not in hit}
    survivors = target.write_folder(unmatched(target.read(hit), staged, keys)) if hit else {}
    _next(target, old, _join_folders(kept, survivors, new), schema, batch)


def merge(
    target: SnapshotTable,
    rows: DataFrame,
    keys: Sequence[str] | None = None,
    key_fixes_partition: bool = False,
    widen: bool = False,
    batch: tuple[str, int] | None = None,
) -> None:
    """Update rows with a known key, insert the others.

    A key that occurs twice in ``rows`` fails the merge and leaves the table as
    it was. Where the key holds the table's time, only partitions that receive
    rows are searched for it; set ``key_fixes_partition`` where the key is made
    from the time (a hash of it, say). ``widen`` adds new columns to the table and lets
    columns grow into wider types (``common_type``); stored files are read as the wider type.
    ``batch`` (stream, number) makes a repeat a no-op.
    """
    keys = keys or target.manifest().keys
    _put(target, rows, keys, True, key_fixes_partition, widen, batch)


def delete_insert(
    target: SnapshotTable,
    rows: DataFrame,
    keys: Sequence[str],
    key_fixes_partition: bool = False,
    widen: bool = False,
) -> None:
    """Delete the rows whose key occurs in ``rows``, insert all of ``rows``."""
    _put(target, rows, keys, False, key_fixes_partition, widen, None)


def swap(
    target: SnapshotTable,
    gone: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    batch: tuple[str, int] | None = None,
) -> None:
    """Delete the rows whose key occurs in ``gone`` and insert ``rows``, in one step.

    The table's time must be among the keys, so the rows to delete lie in the partitions
    that ``gone`` falls into; no other partition is opened. Both frames are read more than
    once: pass stored ones.
    """
    if target.time not in keys:
        raise ValueError(f"the keys must hold the time of the table: {target.time}")
    old = target.manifest()
    if _applied(old, batch):
        return
    schema = _nullable(rows.schema)
    old = old or Manifest(0, schema, {}, list(keys))
    schema = _merged_schema(old.schema, schema, widen=False)
    named = gone.select(_partition_name(target).alias("p")).distinct().collect()
    hit = {r["p"] for r in named} & set(old.folders)
    new = target.write_folder(rows)
    hit |= {p for p in new if len(old.folders.get(p, [])) > MAX_FOLDERS_PER_PARTITION}
    kept = {p: f for p, f in old.folders.items() if p not in hit}
    survivors = target.write_folder(unmatched(target.read(hit), gone, keys)) if hit else {}
    _next(target, old, _join_folders(kept, survivors, new), schema, batch)


def replace_partitions(
    target: SnapshotTable, rows: DataFrame, partitions: Sequence[str], batch: tuple[str, int] | None = None
) -> None:
    """Replace the content of some partitions, named as in the manifest; the others are not opened.

    A partition without new rows becomes empty. New rows of any other partition fail the change.
    """
    old = target.manifest()
    if _applied(old, batch):
        return
    schema = _nullable(rows.schema)
    old = old or Manifest(0, schema, {})
    schema = _merged_schema(old.schema, schema, widen=False)
    new = target.write_folder(rows)
    if stray := sorted(set(new) - set(partitions)):
        raise ValueError(f"new rows in partitions that are not replaced: {stray}")
    kept = {p: f for p, f in old.folders.items() if p not in set(partitions)}
    _next(target, old, _join_folders(kept, new), schema, batch)


def _moment(value: str | dt.date | dt.datetime) -> dt.datetime:
    return dt.datetime.fromisoformat(str(value))


def time_interval(
    target: SnapshotTable,
    rows: DataFrame,
    time: str,
    start: str | dt.date | dt.datetime,
    end: str | dt.date | dt.datetime,
) -> None:
    """Replace the rows of ``[start, end)`` by the recomputed ones.

    New rows outside the interval fail the run. Partitions inside the
    interval are dropped unread; only one cut by a bound is rewritten.
    """
    old = target.manifest()
    schema = _nullable(rows.schema)
    old = old or Manifest(0, schema, {})
    schema = _merged_schema(old.schema, schema, widen=False)
    new = target.write_folder(rows)
    kind = schema[time].dataType.simpleString()
    inside = F.coalesce(in_interval(time, start, end, kind), F.lit(False))
    staged = target.read_folders([f for fs in new.values() for f in fs], schema)
    if not staged.filter(~inside).isEmpty():
        raise ValueError(f"new rows outside [{start}, {end})")

    first, last = _moment(start), _moment(end)
    kept: dict[str, list[str]] = {}
    cut: list[str] = []
    for partition, folders in old.folders.items():
        period = target.period(partition)
        if target.time != time or partition == WHOLE:
            cut.append(partition)
        elif period is None or period[1] <= first or period[0] >= last:
            kept[partition] = folders
        elif period[0] < first or period[1] > last:
            cut.append(partition)
    survivors = target.write_folder(target.read(cut).filter(~inside)) if cut else {}
    _next(target, old, _join_folders(kept, survivors, new), schema)
