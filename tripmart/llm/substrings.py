"""Substring dedup by seed and extend over winnowed anchors.

A window of ``window`` words is the shortest repeat that counts. Its anchor is the
smallest of the hashes of its ``seed``-word runs, so equal windows have equal anchors,
and neighbouring windows mostly share theirs: about two anchors per ten words
are left. Documents meet on anchors first. Only where an anchor occurs in
several documents is the match extended to both sides: the windows around
it are compared by (anchor, window) hash, 128 bits together, with the smallest
document that has them. Windows that overlap or touch merge into
maximal repeats.

Anchors and windows are ordinary rows: minima are aggregated before the shuffle and
joins can split a hot key, so a passage that a third of all documents share
needs no special case. Texts are shuffled by document, never by content.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripmart.llm.common import HashTables, buffers, gram_hashes, mix, pieces, staged, word_hashes

WINDOW = 13
SEED = 5
# Rows that are trimmed at a time: bounds what a task holds beside its batch.
SLICE_ROWS = 512


def _windows(offsets, data, first, last, window, seed, tables):
    """Of all windows of some texts: row, place in the row, anchor, window hash."""
    words, rows, _, _ = word_hashes(offsets, data, first, last, tables)
    count = len(words) - window + 1
    if count <= 0:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), np.empty(0, np.uint64)
    anchors = gram_hashes(words, seed)
    # Sliding minimum: runs of 1, 2, 4, ... anchors, the last step overlapping.
    width, span = window - seed + 1, 1
    while span < width:
        step = min(span, width - span)
        anchors = np.minimum(anchors[: len(anchors) - step], anchors[step:])
        span += step
    at = np.flatnonzero(rows[window - 1 :] == rows[:count])
    begins = np.searchsorted(rows, rows[at], side="left")
    return rows[at], at - begins, anchors[at], gram_hashes(words, window)[at]


def _seed_rows(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(anchor, key) of the texts of a batch (key, text), without repeats in a row."""
    tables = HashTables()
    for batch in batches:
        offsets, data = buffers(batch.column(1))
        key = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last in pieces(offsets):
            rows, _, anchors, _ = _windows(offsets, data, first, last, window, seed, tables)
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors[fresh].view(np.int64)), pa.array(key[rows[fresh]])], names=["anchor", "key"]
            )


def _window_rows(batches: Iterator[pa.RecordBatch], window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Windows of a batch (key, document, anchors, text) whose anchor is in the text's own list."""
    tables = HashTables()
    for batch in batches:
        offsets, data = buffers(batch.column(3))
        key, document = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        borders = batch.column(2).offsets.to_numpy()
        wanted = batch.column(2).values.to_numpy(zero_copy_only=False).view(np.uint64)
        for first, last in pieces(offsets):
            rows, places, anchors, grams = _windows(offsets, data, first, last, window, seed, tables)
            # Row and anchor scrambled into one value; one too many by chance does no harm.
            owners = np.repeat(np.arange(first, last, dtype=np.uint64), np.diff(borders[first : last + 1]))
            listed = mix(wanted[borders[first] : borders[last]] + mix(owners))
            own = np.isin(mix(anchors + mix(rows.astype(np.uint64))), listed)
            rows = rows[own]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors[own].view(np.int64)),
                    pa.array(grams[own].view(np.int64)),
                    pa.array(key[rows]),
                    pa.array(document[rows]),
                    pa.array(places[own].astype(np.int32)),
                ],
                names=["anchor", "gram", "key", "document", "place"],
            )


def _trimmed_rows(batches: Iterator[pa.RecordBatch], window: int, text_at: int, kept: int) -> Iterator[pa.RecordBatch]:
    """Replace the last two columns, window starts and whether the text is a copy, by
    n_words, n_removed, kept_text and removed spans."""
    for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
        n_words, n_removed, kept_text, spans = [], [], [], []
        texts, places, copies = batch.column(text_at).to_pylist(), batch.column(kept), batch.column(kept + 1)
        for text, cuts, copy in zip(texts, places, copies.to_pylist(), strict=True):
            words = (text or "").encode().split()
            n_words.append(len(words))
            if copy and len(words) >= window:
                n_removed.append(len(words))
                spans.append([{"start": 0, "end": len(words)}])
                words = []
            elif not copy and cuts.is_valid:
                starts = np.unique(cuts.values.to_numpy(zero_copy_only=False))
                steps = np.zeros(len(words) + 1, np.int64)
                steps[starts] += 1
                steps[starts + window] -= 1
                covered = np.cumsum(steps)[:-1] > 0
                edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                n_removed.append(int(covered.sum()))
                words = list(compress(words, (~covered).tolist()))
            else:
                n_removed.append(0)
                spans.append([])
            kept_text.append(b" ".join(words).decode())
        added = [
            pa.array(n_words, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array(kept_text, pa.string()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ]
        names = batch.schema.names[:kept] + ["n_words", "n_removed", "kept_text", "removed"]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(kept)] + added, names=names)


def _text_keys(text: str) -> list:
    """Two independent hashes of a text."""
    return [F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("second")]


def repeated_windows(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """(key, second, original, places): a row per distinct text of rows with an id.

    ``key`` and ``second`` are hashes of the text, ``original`` is its smallest id, ``places``
    are the starts of the original's windows that a smaller id has too, NULL if none.
    """
    texts = docs.filter(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        *_text_keys(text_column), F.col(id_column).alias("document"), F.col(text_column).alias("text")
    )
    kind = texts.schema["document"].dataType.simpleString()
    options = {"window": window, "seed": seed}
    originals = staged(texts.groupBy("key", "second").agg(F.min("document").alias("document")), "originals")
    seeds = texts.select("key", "text").mapInArrow(functools.partial(_seed_rows, **options), "anchor long, key long")
    # An anchor counts if different texts have it: copies of one text are whole repeats anyway.
    span = seeds.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    shared = staged(span.filter("low < high").select("anchor"), "shared-anchors")
    lists = seeds.join(shared, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    extended = (
        texts.join(originals.join(lists, "key"), ["key", "second", "document"])
        .select("key", "document", "anchors", "text")
        .mapInArrow(
            functools.partial(_window_rows, **options),
            f"anchor long, gram long, key long, document {kind}, place int",
        )
    )
    windows = staged(extended, "windows")
    firsts = windows.groupBy("anchor", "gram").agg(F.min("document").alias("low"), F.max("document").alias("high"))
    firsts = staged(firsts.filter("low < high").select("anchor", "gram", "low"), "first-windows")
    repeated = windows.join(firsts, ["anchor", "gram"]).filter("low < document")
    places = repeated.groupBy("key").agg(F.collect_list("place").alias("places"))
    found = originals.join(places, "key", "left").withColumnRenamed("document", "original")
    return staged(found, "repeated-windows")


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """All rows with ``n_words``, ``n_removed``, ``kept_text`` and ``removed`` (word spans).

    A word goes if a window of ``window`` words covers it that also starts in
    a document with a smaller id; windows are judged on the input. ``kept_text`` joins
    the words that stay by one space. NULL texts count as empty; texts shorter than a
    window lose nothing. Rows without an id are neither trimmed nor a reason to trim
    others. Rows with the same id never trim each other, repeated rows get equal results. An
    empty table gives an empty result. Columns of ``docs`` named like a result are
    replaced.
    """
    added = ["n_words", "n_removed", "kept_text", "removed"]
    docs = docs.drop(*[c for c in docs.columns if c in added and c not in (id_column, text_column)])
    found = repeated_windows(docs, id_column, text_column, window, seed).select(
        F.col("key").alias("_key"), F.col("second").alias("_second"), F.col("original").alias("_original"), F.col("places").alias("_places")
    )
    key, second = _text_keys(text_column)
    same = (F.col("_own") == F.col("_key")) & (F.col("_other") == F.col("_second"))
    joined = docs.withColumn("_own", key).withColumn("_other", second).join(found, same, "left")
    original, document = F.col("_original"), F.col(id_column)
    joined = joined.select(
        *docs.columns,
        F.when(document == original, F.col("_places")).alias("_places"),
        F.coalesce(document > original, F.lit(False)).alias("_copy"),
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(
        functools.partial(_trimmed_rows, window=window, text_at=docs.columns.index(text_column), kept=len(docs.columns)),
        f"{fields}, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>",
    )
