"""Helpers that several operators share: staged tables, running totals, word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tripmart.session import work_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The bytes that separate words, as a character class and as bytes.
SPACE = "[\\x20\\x09-\\x0D]"
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

# Texts are hashed in pieces of about this many bytes, which keeps the arrays in cache.
PIECE_BYTES = 1 << 20

# Words longer than this are hashed one by one.
LONG_WORD = 4096

_STEP = np.uint64(0xD6E8FEB86659FD93)


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


@contextlib.contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """Shuffle files of a finished write are not needed again: let Spark remove them."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    with _shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def returning_memory(function):
    """A function for ``mapInArrow`` whose task gives freed memory back to the system at its end.

    A worker lives on between tasks, beside stages that need the executor's memory for other things.
    """

    @functools.wraps(function)
    def run(*args, **options):
        yield from function(*args, **options)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of(text: str) -> Column:
    """Unsigned crc32 of a text's UTF-8 bytes; NULL counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))


def row_key(id_column: str, crc: str) -> Column:
    """60 pseudo-random bits for a row; rows without an id are spread by their text."""
    name = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("crc "), F.col(crc)))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def hash_buckets(rows: int, rows_per_bucket: int) -> int:
    return max(1, math.ceil(rows / rows_per_bucket))


def bucket_of(key: Column, buckets: int) -> Column:
    """The slice of the key range that a 60-bit key lies in; rises with the key."""
    return F.floor(F.shiftright(key, 20) * F.lit(buckets) / F.lit(float(1 << 40))).cast("long")


def repeated_keys(df: DataFrame, key: str, ties: list[str], limit: int) -> DataFrame:
    """(_equal): hashes of the keys, ties included, that more than ``limit`` rows share.

    At most rows / ``limit`` of them. Rows are counted before they are shuffled.
    """
    counts = df.groupBy(F.xxhash64(key, *ties).alias("_equal")).agg(F.count(F.lit(1)).alias("_n"))
    return staged(counts.filter(F.col("_n") > limit).select("_equal"), "repeated-keys")


def _unpacked(packed: DataFrame, value: str, before: str, part_rows: int) -> DataFrame:
    """Each row as often as ``_times`` says, ``before`` rising by ``value``; in tasks of ``part_rows`` rows of one kind."""
    last = F.ceil(F.col("_times") / F.lit(part_rows)) - 1
    parts = packed.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    tasks = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("_part") * part_rows
    final = F.least(first + part_rows, F.col("_times")) - 1
    rows = parts.repartition(tasks, "_row", "_part").withColumn("_place", F.explode(F.sequence(first, final)))
    return rows.withColumn(before, F.col(before) + F.col("_place") * F.col(value)).drop("_part", "_place")


def running_totals(
    df: DataFrame,
    group: str,
    key: str,
    value: str,
    ties: list[str],
    buckets: int,
    before: str,
    total: str,
    repeated: DataFrame | None = None,
    part_rows: int = 20_000,
) -> DataFrame:
    """Add ``before``, the sum of ``value`` over the group's rows ahead of each row in
    the order of ``key``, and ``total``, the sum over its group.

    A group is cut into slices of its key range. Sums per slice are aggregated
    first; a window adds them up, one small row per slice; then each slice is
    ordered by itself. So no task holds a group, however large. ``group`` must
    not be NULL. Rows that agree in ``key`` and ``ties`` are interchangeable.

    A slice cannot divide one key. Keys that many rows share (``repeated``, see ``repeated_keys``) are
    therefore packed before the shuffle: rows equal in all columns become one row with their
    number, which is unpacked into rows behind the window, ``part_rows`` a task.
    """
    sliced = df.withColumn("_slice", bucket_of(F.col(key), buckets))
    single = [F.lit(1).cast("long").alias("_times"), F.lit(0).cast("long").alias("_row")]
    packs = repeated is not None and not repeated.isEmpty()
    if packs:
        marked = sliced.withColumn("_equal", F.xxhash64(key, *ties))
        packed = (
            marked.join(repeated, "_equal", "left_semi")
            .groupBy(*sliced.columns)
            .agg(F.count(F.lit(1)).alias("_times"))
            .withColumn("_row", F.xxhash64(*df.columns))
        )
        others = marked.join(repeated, "_equal", "left_anti").select(*sliced.columns, *single)
        rows = others.withColumn("_packed", F.lit(False)).unionByName(packed.withColumn("_packed", F.lit(True)))
    else:
        rows = sliced.select("*", *single)
    amount = F.col(value) * F.col("_times")
    sums = rows.groupBy(group, "_slice").agg(F.sum(amount).alias("_sum"))
    by_slice = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    offsets = sums.select(
        group,
        "_slice",
        F.coalesce(F.sum("_sum").over(by_slice), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(whole).alias(total),
    )
    inside = (
        Window.partitionBy(group, "_slice")
        .orderBy(key, *ties, "_row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        rows.join(offsets, [group, "_slice"])
        .withColumn(before, F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_slice", "_offset")
    )
    if packs:
        several = _unpacked(placed.filter("_packed"), value, before, part_rows)
        placed = placed.filter("NOT _packed").unionByName(several).drop("_packed")
    return placed.drop("_times", "_row")


# ---------------------------------------------------------------- words in numpy


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# The bytes of a 64-bit chunk that belong to a word with so many bytes left.
_CHUNK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class HashTables:
    """What tells words from the bytes between them; a task makes it once."""

    def __init__(self):
        self.inside = np.ones(256, bool)
        self.inside[list(SPACE_BYTES)] = False


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; NULL has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES):
    """Ranges of consecutive texts with about ``limit`` bytes, one text at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last
        first = last


def word_hashes(offsets: np.ndarray, data: np.ndarray, first: int, last: int, tables: HashTables):
    """Word hashes of texts ``first`` to ``last``; their rows; their start and end bytes.

    A word is scrambled eight bytes at a time, each chunk into the hash of all before it and the
    word's length. So short words of one length never collide, and longer ones don't for
    their form, as they would under a polynomial modulo a power of two.
    """
    low, high = int(offsets[first]), int(offsets[last])
    part = data[low:high]
    inside = tables.inside[part]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = (offsets[first:last] - low).astype(np.int64)
    edges = edges[edges < len(part)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, none
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:]
    cut = edges[edges > 0] - 1
    ends_here[cut] = inside[cut]
    ends = np.flatnonzero(ends_here) + 1
    hashes = _scrambled(part, starts, ends - starts)
    rows = np.searchsorted(offsets[first : last + 1] - low, starts, side="right") - 1 + first
    return hashes, rows, starts + low, ends + low


def _scrambled(part: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of the words of some bytes."""
    padded = np.concatenate([part, np.zeros(8, np.uint8)])
    chunks = np.ndarray((len(part) + 1,), "<u8", padded, strides=(1,))
    hashes = mix(lengths.astype(np.uint64) + _STEP)
    hashes = mix(hashes ^ (chunks[starts] & _CHUNK[np.minimum(lengths, 8)]))
    for word in np.flatnonzero(lengths > LONG_WORD):
        content = part[starts[word] : starts[word] + lengths[word]].tobytes()
        hashes[word] = int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little")
    at, done = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD)), 8
    while len(at):
        more = chunks[starts[at] + done] & _CHUNK[np.minimum(lengths[at] - done, 8)]
        hashes[at] = mix(hashes[at] * _STEP ^ more)
        done += 8
        at = at[lengths[at] > done]
    return hashes


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (row borders are the caller's business)."""
    count = max(0, len(words) - n + 1)
    grams = np.zeros(count, np.uint64)
    for k in range(n):
        grams *= _STEP
        grams += words[k : k + count]
    return mix(grams)
