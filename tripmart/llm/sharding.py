"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``tokens`` places on a ring of ``cells``. A row's key gives its
cell, and the next token clockwise gives its home shard. A shard holds a bounded
number of rows; what does not fit continues clockwise to the next shard with
room. The bounds add up to the number of rows and differ by one at most, so the
counts are exactly balanced, and only the overflow leaves its home.

Only counts per cell reach the driver: their number is a parameter, not a
function of the data. The rows themselves are ranked within slices of a cell,
so no task holds a cell; equal rows are counted first, so none holds the rows of one id.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tripmart.frames import literal_rows
from tripmart.llm.common import crc_of, hash_buckets, repeated_keys, row_key, running_totals

CELLS = 4096
TOKENS = 64
ROWS_PER_SLICE = 20_000

_SEGMENTS = T.StructType(
    [
        T.StructField("_cell", T.LongType()),
        T.StructField("_from", T.LongType()),
        T.StructField("_to", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("_base", T.LongType()),
        T.StructField("home_shard", T.IntegerType()),
    ]
)


def ring(shards: int, tokens: int, cells: int) -> list[tuple[int, int]]:
    """Tokens as (cell, shard), sorted; each in a cell of its own.

    A shard's tokens do not depend on how many other shards there are, but for
    the rare token whose cell is taken: it moves on to the next free cell.
    """
    if shards < 1 or shards * tokens > cells:
        raise ValueError("the ring needs a cell for each token, and one shard at least")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for token in range(tokens):
            cell = zlib.crc32(f"shard {shard} token {token}".encode()) % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


@dataclass
class Segment:
    """Rows ``first`` to ``last`` (exclusive) of a cell go to ``shard``, from slot ``base`` on."""

    cell: int
    first: int
    last: int
    shard: int
    base: int
    home: int


def place(counts: dict[int, int], shards: int, tokens: int = TOKENS, cells: int = CELLS) -> list[Segment]:
    """Divide the rows of the cells among the shards.

    First each shard takes rows of its own cells in ring order up to its bound;
    then the rest, again in ring order, continues clockwise.
    """
    places = ring(shards, tokens, cells)
    rows = sum(counts.values())
    room = [rows // shards + (shard < rows % shards) for shard in range(shards)]
    used = [0] * shards
    segments: list[Segment] = []
    overflow: list[tuple[int, int, int, int]] = []

    def put(cell: int, first: int, last: int, shard: int, home: int) -> int:
        fits = min(last - first, room[shard] - used[shard])
        if fits > 0:
            segments.append(Segment(cell, first, first + fits, shard, used[shard], home))
            used[shard] += fits
        return first + max(0, fits)

    cells_of_tokens = [cell for cell, _ in places]
    for cell in sorted(counts):
        at = bisect.bisect_left(cells_of_tokens, cell) % len(places)
        home = places[at][1]
        first = put(cell, 0, counts[cell], home, home)
        if first < counts[cell]:
            overflow.append((cell, first, at, home))
    for cell, first, at, home in overflow:
        while first < counts[cell]:
            at = (at + 1) % len(places)
            first = put(cell, first, counts[cell], places[at][1], home)
    return segments


def shard_rows(
    docs: DataFrame,
    shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: int = TOKENS,
    cells: int = CELLS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """All rows with ``shard``, ``slot`` (gapless from 0 in each shard) and ``home_shard``.

    The key is the id; rows without one are spread by their text. Rows follow each other by key, id and text;
    repeated rows are interchangeable and placed one by one. NULL, empty and very long texts are ordinary rows: a
    text is read for its checksum only. An empty table gives an empty result. Columns of ``docs`` that have a name of the
    result are replaced; all others stay.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot", "home_shard")
    keyed = (
        docs.withColumn("_crc", crc_of(text_column))
        .withColumn("_key", row_key(id_column, "_crc"))
        .withColumn("_one", F.lit(1).cast("long"))
        .withColumn("_cell", F.shiftright("_key", 30) * F.lit(cells).cast("long"))
        .withColumn("_cell", F.shiftright("_cell", 30))
    )
    counts = {r["_cell"]: r["n"] for r in keyed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments = place(counts, shards, tokens, cells)
    lookup = literal_rows(
        spark, ((s.cell, s.first, s.last, s.shard, s.base, s.home) for s in segments), _SEGMENTS
    )
    buckets = max(cells, hash_buckets(sum(counts.values()), rows_per_slice))
    ties = [id_column, "_crc"]
    repeated = repeated_keys(keyed, "_key", ties, rows_per_slice)
    ranked = running_totals(
        keyed, "_cell", "_key", "_one", ties, buckets, "_rank", "_rows", repeated, rows_per_slice
    )
    # Bounded: at most one segment per cell and shard.
    return (
        ranked.join(lookup, "_cell")
        .filter((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
        .withColumn("slot", F.col("_base") + F.col("_rank") - F.col("_from"))
        .select(*docs.columns, "shard", "slot", "home_shard")
    )
