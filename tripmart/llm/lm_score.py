"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Documents are dealt into blocks by hash. A block explodes its texts into n-grams and
keeps each once with its count, so a frequent n-gram is one entry per block however
often it occurs. Entries are dealt by ranges of the n-gram hash: a partition of the count table
sums its n-grams over all blocks and is joined back to the entries it came from. The
counts return to their blocks, where the terms are summed per document. Entries
of one block and one table partition travel as one row of arrays. Numbers of blocks and
partitions follow the size of the corpus, so each fits a task at any size. Within a block,
texts are worked on a megabyte at a time; beside that a task holds the block's distinct
n-grams of one order (of all orders where scores are summed) and their counts.

By default a document's own n-grams don't count for its score. Otherwise no n-gram
would ever be unseen, and nothing would back off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripmart.llm.common import HashTables, buffers, gram_hashes, mix, pieces, staged, word_hashes

ORDER = 2
BACKOFF = 0.4
BLOCK_BYTES = 8 << 20

_ENTRIES = "part long, size int, block long, grams array<long>, counts array<long>"
_COUNTED = "block long, size int, part long, totals array<long>, own long"


def _pieces(texts: pa.Array, tables: HashTables):
    """Word hashes, their rows, and the range of rows, of the texts a piece at a time."""
    offsets, data = buffers(texts)
    for first, last in pieces(offsets):
        yield *word_hashes(offsets, data, first, last, tables)[:2], first, last


def _grams(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes, and the positions of their last words."""
    count = max(0, len(words) - size + 1)
    inside = np.flatnonzero(rows[size - 1 :] == rows[:count])
    return gram_hashes(words, size)[inside], inside + size - 1


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in the order of their hash, and counts, from those of several pieces."""
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    distinct, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    return distinct, np.bincount(where, np.concatenate([n for _, n in found])).astype(np.int64)


def _distinct(texts: list[pa.Array], order: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per order, the distinct n-grams of each piece with their counts."""
    tables = HashTables()
    found: list[list] = [[] for _ in range(order)]
    for part in texts:
        for words, rows, _, _ in _pieces(part, tables):
            for size in range(1, order + 1):
                found[size - 1].append(np.unique(_grams(words, rows, size)[0], return_counts=True))
    return found


def _borders(distinct: np.ndarray, parts: int) -> np.ndarray:
    """Where the n-grams of each table partition begin; a partition is a range of hashes."""
    part = ((distinct >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _exploded(block: int, size: int, distinct: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    borders = _borders(distinct, parts)
    part = np.flatnonzero(np.diff(borders))
    ends = pa.array(np.r_[borders[part], borders[-1:]].astype(np.int32))
    columns = [
        pa.array(part),
        pa.array(np.full(len(part), size, np.int32)),
        pa.array(np.full(len(part), block, np.int64)),
        pa.ListArray.from_arrays(ends, pa.array(distinct.view(np.int64))),
        pa.ListArray.from_arrays(ends, pa.array(counts)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "size", "block", "grams", "counts"])


def _count(part: pa.Table) -> pa.Table:
    """Sum the counts of each n-gram of one order over the blocks; give every entry its total."""
    grams = part["grams"].combine_chunks()
    borders = np.r_[0, np.cumsum(grams.value_lengths().to_numpy())]
    where = np.unique(grams.flatten().to_numpy(), return_inverse=True)[1]
    del grams
    counts = part["counts"].combine_chunks().flatten().to_numpy()
    totals = np.bincount(where, counts).astype(np.int64)[where]
    return pa.table(
        [
            part["block"],
            part["size"],
            part["part"],
            pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(totals)),
            pa.array(np.add.reduceat(counts, borders[:-1])),
        ],
        names=["block", "size", "part", "totals", "own"],
    )


def _totals(counted: pa.Table, size: int) -> np.ndarray:
    """Counts of a block's distinct n-grams of one order, in the order of their hash."""
    chosen = np.flatnonzero(counted["size"].to_numpy() == size)
    chosen = chosen[np.argsort(counted["part"].to_numpy()[chosen])]
    lists = [counted["totals"][int(i)].values.to_numpy() for i in chosen]
    return np.concatenate(lists) if lists else np.empty(0, np.int64)


def _score(
    block: pa.Table, counted: pa.Table, order: int, total: int, exclude_self: bool, backoff: float, kept: list[str]
) -> pa.Table:
    text = block["text"].combine_chunks()
    known = [(_merged(found)[0], _totals(counted, n)) for n, found in enumerate(_distinct([text], order), 1)]
    del counted
    results = []
    for words, rows, first, last in _pieces(text, HashTables()):
        n_words = np.bincount(rows - first, minlength=last - first)
        begins = np.r_[0, np.cumsum(n_words)[:-1]]
        longest = np.minimum(np.arange(len(words)) - begins[rows - first] + 1, order)
        others = np.maximum(total - (n_words if exclude_self else 0), 1)
        others = np.broadcast_to(others, (last - first,))[rows - first]
        # Nothing seen: as rare as a word seen once in one more word, one step below the unigrams.
        value = longest * math.log(backoff) - np.log(others + 1.0)
        used = np.zeros(len(words), np.int64)
        under = others
        for size, (distinct, totals) in enumerate(known, 1):
            grams, ends = _grams(words, rows, size)
            own, where = np.unique(grams, return_inverse=True)
            seen = np.zeros(len(words), np.int64)
            seen[ends] = totals[np.searchsorted(distinct, own)][where]
            if exclude_self and len(grams):
                keys = mix(grams + mix(rows[ends].astype(np.uint64)))
                _, where, often = np.unique(keys, return_inverse=True, return_counts=True)
                seen[ends] -= often[where]
            at = np.flatnonzero((seen > 0) & (longest >= size))
            history = under[at] if size == 1 else under[at - 1]
            value[at] = np.log(seen[at] / history) + (longest[at] - size) * math.log(backoff)
            used[at] = size
            under = seen
        sums = np.bincount(rows - first, value, minlength=last - first)
        backed = np.bincount(rows - first, used < longest, minlength=last - first).astype(np.int64)
        mean = [None if n == 0 else s / n for s, n in zip(sums.tolist(), n_words.tolist(), strict=True)]
        columns = [block[name].slice(first, last - first) for name in kept]
        results.append(
            pa.table(
                [*columns, pa.array(n_words.astype(np.int64)), pa.array(backed), pa.array(mean, pa.float64())],
                names=[*kept, "n_words", "n_backoff", "log_score"],
            )
        )
    return pa.concat_tables(results)


def score_texts(
    docs: DataFrame,
    text_column: str = "text",
    order: int = ORDER,
    backoff: float = BACKOFF,
    exclude_self: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows without their text, with ``n_words``, ``n_backoff`` and ``log_score``.

    ``log_score`` is the mean over the document's words of the natural logarithm of the
    stupid-backoff score: count of the longest known n-gram over that of its history, times
    ``backoff`` for each order given up. A word that no other document has scores
    one order below the unigrams, as 1 / (words of others + 1). ``n_backoff``
    counts the words that gave up an order. Counts are over all rows; with
    ``exclude_self`` without the row itself (a copy in another row does count).
    NULL and empty texts have no words and a NULL score. An empty table gives an
    empty result. Columns of ``docs`` named like a result are replaced.
    """
    if order < 1:
        raise ValueError("order starts at 1")
    added = ("n_words", "n_backoff", "log_score")
    kept = [c for c in docs.columns if c != text_column and c not in added]
    size = docs.agg(F.sum(F.octet_length(text_column)).alias("bytes")).first()["bytes"] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    # Names of the work columns cannot meet those of the table: all are positional here.
    renamed = [F.col(c).alias(f"c{i}") for i, c in enumerate(kept)]
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in kept if _hashable(docs, c)], F.col(text_column)), F.lit(blocks))
    dealt = docs.select(*renamed, F.col(text_column).alias("text"), spread.cast("long").alias("block"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, block = [], 0
        for batch in batches:
            block = batch["block"][0].as_py() if batch.num_rows else block
            texts.append(batch["text"])
        for size, found in enumerate(_distinct(texts, order), 1):
            distinct, counts = _merged(found)
            found.clear()
            yield _exploded(block, size, distinct, counts, blocks)

    entries = dealt.select("block", "text").groupBy("block").applyInArrow(explode, _ENTRIES)
    counted = staged(entries.groupBy("part", "size").applyInArrow(lambda part: _count(part), _COUNTED), "counted")
    total = counted.filter("size = 1").agg(F.sum("own").alias("n")).first()["n"] or 0
    names = [f"c{i}" for i in range(len(kept))]
    fields = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for n, c in zip(names, kept, strict=True))

    def score(block, counts):
        return _score(block, counts, order, total, exclude_self, backoff, names)

    scored = (
        dealt.groupBy("block")
        .cogroup(counted.groupBy("block"))
        .applyInArrow(score, f"{fields}n_words long, n_backoff long, log_score double")
    )
    return scored.select(*[F.col(n).alias(c) for n, c in zip(names, kept, strict=True)], *added)


def _hashable(docs: DataFrame, column: str) -> bool:
    return "map<" not in docs.schema[column].dataType.simpleString()
