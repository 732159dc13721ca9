"""Approximate nearest neighbours by cross-polytope hashing.

A vector is turned by a fast pseudo-rotation (three rounds of random signs and a
Hadamard transform) and assigned to the nearest signed axis. Every table has
rotations of its own: one, or in large tables several, whose axes together name the bucket, so that
buckets stay small however many rows there are. All rows are in all tables; a query probes its nearest
axes (or combinations of axes, by the sum of their products) in each, and its candidates are
reranked by the exact inner product.

How many probes a query takes follows from the number of rows. Neighbours among random directions are the
hardest case: the ``k`` nearest of n are found at an angle that n alone decides, so the share of
them that a number of probes meets can be tried out beforehand on random pairs at that angle. With more rows the
nearest are nearer, and fewer probes do: the share of all rows that are compared falls as the table grows.

Rows and queries are hashed by their directions, so one long row changes no other row's
bucket. Rows are told apart by octaves of their norms, and each octave is searched as a table of its own. At most
``LONGEST_ROWS`` rows of octaves above the most frequent one, the longest rows, are compared with every query: they can
be a query's best at a wide angle.

Candidates of a bucket are compared with its queries as blocks of two matrices. A full
bucket is divided into blocks of bounded size, so it is searched whole, in several tasks.
A query that finds fewer than ``k`` is compared with all rows, in blocks as well.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tripmart.llm.common import staged

TABLES = 8
NEAREST = 20
# Share of the nearest among random directions that the probes are to meet.
RECALL = 0.95
# So many rows longer than most are compared with every query.
LONGEST_ROWS = 1_024
# Octaves below the most frequent one that are told apart; shorter rows share one.
OCTAVES_BELOW = 2
# Rows of a bucket on average, from which on another rotation is added to the keys.
BUCKET_ROWS = 16_384
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 1_024
SEED = 17


def usable_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector as doubles) of rows that take part, one per id and vector.

    Left out are NULL ids and vectors, zero vectors, those with a NULL or non-finite
    component, and those that don't have the most frequent length.
    """
    vector = F.col(vector_column).cast("array<double>")
    kept = (
        vectors.select(F.col(id_column).alias("vec_id"), vector.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)))
        .filter(F.exists("vector", lambda x: x != 0.0))
    )
    size = kept.agg(F.mode(F.size("vector"), True).alias("n")).first()["n"]
    return kept.filter(F.size("vector") == F.lit(size if size is not None else 0))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, span = x.shape[1], 1
    while span < n:
        pairs = x.reshape(len(x), n // (2 * span), 2, span)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        span *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, table: int) -> np.ndarray:
    """The pseudo-rotation of a table (or of one of its parts)."""
    signs = np.random.default_rng([SEED, table]).choice(np.array([-1.0, 1.0]), (3, unit.shape[1]))
    for flips in signs:
        unit = _hadamard(unit * flips)
    return unit


def padded_size(length: int) -> int:
    """The power of two that vectors are filled up to."""
    return 1 << max(0, length - 1).bit_length()


def _units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, padded to a power of two."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = np.zeros((len(vectors), padded_size(vectors.shape[1])))
    unit[:, : vectors.shape[1]] = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    return unit


def _products(parts: list[np.ndarray]) -> np.ndarray:
    """Per row, the products with all signed axes, or their sums over all combinations of several parts' axes."""
    total = None
    for turned in parts:
        signed = np.concatenate([turned, -turned], axis=1)
        total = signed if total is None else (total[:, :, None] + signed[:, None, :]).reshape(len(signed), -1)
    return total


def rotations_per_key(rows: int, axes: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """How many rotations name a bucket, so that buckets hold ``bucket_rows`` on average at most (three rotations at most)."""
    count = 1
    while count < 3 and rows / axes**count > bucket_rows:
        count += 1
    return count


def choose_probes(rows: int, k: int, length: int, tables: int, rotations: int = 1, recall: float = RECALL) -> int:
    """Probes per table that meet ``recall`` of the ``k`` nearest of so many random directions.

    The nearest are at the cosine that ``k`` of ``rows`` random directions exceed. Random pairs at that
    cosine are hashed; how far down the list of a query's buckets its neighbour's bucket
    stands gives the share that any number of probes meets.
    """
    size = padded_size(length)
    share = min(0.5, k / max(rows, 1))
    cosine = min(0.99, NormalDist().inv_cdf(1.0 - share) / math.sqrt(length))
    random = np.random.default_rng(SEED)
    pairs = 2_000 if rotations == 1 else 200
    ranks = []
    for _ in range(10 if rotations == 1 else 5):
        row, other = ([random.normal(size=(pairs, size)) / math.sqrt(size) for _ in range(rotations)] for _ in range(2))
        query = [cosine * a + math.sqrt(1.0 - cosine**2) * b for a, b in zip(row, other, strict=True)]
        own = np.argmax(_products(row), axis=1)
        products = _products(query)
        ranks.append((products > products[np.arange(pairs), own][:, None]).sum(axis=1))
    met = np.sort(np.concatenate(ranks))
    single = 1.0 - (1.0 - recall) ** (1.0 / tables)
    return int(met[min(len(met) - 1, math.ceil(single * len(met)))]) + 1


def _bucket_rows(
    batches: Iterator[pa.RecordBatch], tables: int, rotations: int, probes: dict[int, int] | None
) -> Iterator[pa.RecordBatch]:
    """(octave, table, bucket, vec_id, vector) of rows (octave, id, vector): the nearest bucket of
    every table; or of queries, with ``probes`` of each octave."""
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = _units(_matrix(batch.column(2)))
        for table in range(tables):
            products = _products([rotated(unit, table * 8 + part) for part in range(rotations)])
            for octave, wanted in (probes or {0: 1}).items():
                count = min(wanted, products.shape[1])
                nearest = np.argpartition(-products, count - 1, axis=1)[:, :count]
                rows = pa.array(np.repeat(np.arange(batch.num_rows), count))
                octaves = batch.column(0) if probes is None else pa.array(np.full(len(rows), octave, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        octaves,
                        pa.array(np.full(len(rows), table, np.int32)),
                        pa.array(nearest.ravel().astype(np.int32)),
                        batch.column(1).take(rows),
                        batch.column(2).take(rows),
                    ],
                    names=["octave", "table", "bucket", "vec_id", "vector"],
                )


def _first_of_equals(vectors: np.ndarray, many: int) -> np.ndarray:
    """Rows without those that ``many`` equal rows precede."""
    _, group = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.argsort(group, kind="stable")
    begins = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0])
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    return np.sort(order[rank < many])


def nearest_in_block(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """(query_id, vec_id, score): each query's ``k`` best rows of the block, ties to smaller ids.

    Sums of products are taken row by row in one fixed way, so a pair has the same score in
    every block; the matrix product only preselects.
    """
    ids = rows["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], _matrix(rows["vector"])[order]
    # Of equal vectors only the k + 1 smallest ids can be an answer (one may be the query).
    some = _first_of_equals(vectors, k + 1)
    ids, vectors = ids[some], vectors[some]
    query_ids, query_vectors = queries["vec_id"].to_numpy(), _matrix(queries["vector"])
    product = query_vectors @ vectors.T
    product[query_ids[:, None] == ids[None, :]] = -np.inf
    count = min(k, len(ids))
    least = np.partition(product, len(ids) - count, axis=1)[:, len(ids) - count]
    margin = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(least), least, 0.0)))
    found = []
    for q in range(len(query_ids)):
        near = np.flatnonzero((product[q] >= least[q] - margin[q]) & np.isfinite(product[q]))
        score = (vectors[near] * query_vectors[q]).sum(axis=1)
        best = np.lexsort((ids[near], -score))[:k]
        found.append((np.full(len(best), query_ids[q]), ids[near][best], score[best]))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    return pa.table([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


_FOUND = "query_id long, vec_id long, score double"


def _in_blocks(queries: DataFrame, rows: DataFrame, keys: list[str], k: int, block_rows: int, block_queries: int) -> DataFrame:
    """Best rows per query and block, where queries and rows agree in ``keys``."""
    sizes = (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .join(queries.groupBy(*keys).agg(F.count(F.lit(1)).alias("_queries")), keys)
        .select(*keys, F.ceil(F.col("_rows") / block_rows).cast("int").alias("_r"), F.ceil(F.col("_queries") / block_queries).cast("int").alias("_q"))
    )
    sizes = staged(sizes, "block-sizes")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def mine(n):
        return F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")

    dealt_rows = rows.join(sizes, keys).select(*keys, mine("_r").alias("_rb"), every("_q").alias("_qb"), "vec_id", "vector")
    dealt_queries = queries.join(sizes, keys).select(*keys, every("_r").alias("_rb"), mine("_q").alias("_qb"), "vec_id", "vector")
    by = [*keys, "_rb", "_qb"]

    def search(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["query_id", "vec_id", "score"])
        return nearest_in_block(left, right, k)

    return dealt_queries.groupBy(*by).cogroup(dealt_rows.groupBy(*by)).applyInArrow(search, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct rows of each query, ranked from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return single.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def octave_classes(counts: dict[int, int]) -> tuple[set[int], int]:
    """Octaves that are searched whole, and the last one told apart, from the rows of each octave (0: the longest)."""
    if not counts:
        return set(), 0
    frequent = min(counts, key=lambda o: (-counts[o], o))
    whole, rows = set(), 0
    for octave in sorted(o for o in counts if o < frequent):
        rows += counts[octave]
        if rows > LONGEST_ROWS:
            break
        whole.add(octave)
    return whole, frequent + OCTAVES_BELOW


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = NEAREST,
    tables: int = TABLES,
    recall: float = RECALL,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows found nearest to each query.

    Ids are whole numbers. A row is no neighbour of a query with its own id. Unusable vectors (see
    ``usable_vectors``) take no part on either side. Of repeated rows of an id the
    best counts. A query has fewer than ``k`` neighbours only if there are no more
    rows. Empty tables give an empty result. Other columns are ignored.
    """
    usable = usable_vectors(vectors, id_column, vector_column)
    asked = usable_vectors(queries, id_column, vector_column)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    seen = usable.agg(F.max(norm).alias("n"), F.max(F.size("vector")).alias("length")).first()
    limit, length = seen["n"] or 1.0, seen["length"] or 1
    # Norms too small to be told from zero have no logarithm: they are the shortest.
    octave = F.coalesce(F.floor(F.log2(F.lit(limit)) - F.log2(norm)), F.lit(1 << 20)).cast("long")
    counts = {r["octave"]: r["n"] for r in usable.groupBy(octave.alias("octave")).agg(F.count(F.lit(1)).alias("n")).collect()}
    whole, last = octave_classes(counts)
    sizes: dict[int, int] = {}
    for o, n in counts.items():
        if o not in whole:
            sizes[min(o, last)] = sizes.get(min(o, last), 0) + n
    rotations = rotations_per_key(max(sizes.values(), default=0), 2 * padded_size(length), bucket_rows)
    probes = {o: choose_probes(n, k, length, tables, rotations, recall) for o, n in sorted(sizes.items())}
    one = F.lit(0).alias("all")
    kind = "octave long, table int, bucket int, vec_id long, vector array<double>"
    placed = usable.filter(~octave.isin(sorted(whole))).select(F.least(octave, F.lit(last)).alias("octave"), "vec_id", "vector")
    index = placed.mapInArrow(functools.partial(_bucket_rows, tables=tables, rotations=rotations, probes=None), kind)
    probed = asked.select(F.lit(0).cast("long").alias("octave"), "vec_id", "vector").mapInArrow(
        functools.partial(_bucket_rows, tables=tables, rotations=rotations, probes=probes), kind
    )
    found = _in_blocks(probed, index, ["octave", "table", "bucket"], k, block_rows, block_queries)
    longest = usable.filter(octave.isin(sorted(whole))).select(one, "vec_id", "vector")
    found = found.unionByName(_in_blocks(asked.select(one, "vec_id", "vector"), longest, ["all"], k, block_rows, block_queries))
    best = staged(_best(found, k), "neighbours")
    full = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    short = asked.join(full, F.col("vec_id") == F.col("query_id"), "left_anti")
    if not short.isEmpty():
        every = _in_blocks(short.select(one, "vec_id", "vector"), usable.select(one, "vec_id", "vector"), ["all"], k, block_rows, block_queries)
        best = best.join(full, "query_id", "left_semi").unionByName(_best(every, k))
    return best.select("query_id", "rank", "vec_id", "score")
