"""Jaccard join of documents on word n-grams by MinHash banding.

Equal word sequences are one text; its copies are members, not pairs. Each text
gets a MinHash signature in bands. Numbers of bands and rows are chosen so that two
texts at the threshold share a band with the target recall. Texts meet by
band hash, and every pair of texts that share a bucket is compared on the full n-gram
sets. A bucket is compared in blocks of bounded size, in several tasks; a pair is
looked at in the first band it shares only, and of buckets with equal texts one is kept.
Links stay in their task: what leaves it is, per text, its number of links and one text
of its group there. Classes are the connected components of all links.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripmart.llm.common import SPACE, HashTables, buffers, gram_hashes, mix, pieces, returning_memory, staged, word_hashes

NGRAM = 5
WORD = "[^\\x20\\x09-\\x0D]"
SIMILARITY = 0.8
RECALL = 0.999
MAX_HASHES = 144
# Buckets with more texts are compared in blocks of this size.
PART = 1_000
# N-grams of a block that are counted in one matrix product.
COLUMNS = 2_048


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective choice that reaches the recall at ``similarity``."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        hit = similarity**rows
        bands = 1 if hit >= 1.0 else math.ceil(math.log(1.0 - recall) / math.log1p(-hit))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def _grams(offsets, data, first, last, ngram, tables):
    """(row, hash) of all n-grams of some texts, by row; a text shorter than that is one n-gram."""
    words, rows, _, _ = word_hashes(offsets, data, first, last, tables)
    begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, np.int64)
    place = np.arange(len(rows)) - np.repeat(begins, np.diff(np.r_[begins, len(rows)]))
    salted = [mix(words + mix(place.astype(np.uint64) + np.uint64(salt))) for salt in (1, 1 << 40)]
    content = [np.add.reduceat(s, begins) if len(begins) else s for s in salted]
    count = max(0, len(words) - ngram + 1)
    full = rows[ngram - 1 :] == rows[:count]
    grams, owner = gram_hashes(words, ngram)[full], rows[:count][full]
    short = np.diff(np.r_[begins, len(rows)]) < ngram
    owner = np.r_[owner, rows[begins[short]]]
    grams = np.r_[grams, content[0][short]]
    order = np.argsort(owner, kind="stable")
    return owner[order], grams[order], rows[begins], content


@returning_memory
def _signature_rows(batches: Iterator[pa.RecordBatch], ngram: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """(id, content hash in two halves, band hashes) of the texts with words of a batch (id, text)."""
    tables = HashTables()
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        offsets, data = buffers(batch.column(1))
        for first, last in pieces(offsets):
            owner, grams, texts, content = _grams(offsets, data, first, last, ngram, tables)
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, np.int64)
            hashes = np.empty((len(texts), bands), np.uint64)
            for band in range(bands if len(texts) else 0):
                value = np.full(len(texts), band, np.uint64)
                for factor in factors[band * rows : (band + 1) * rows]:
                    least = np.minimum.reduceat(grams * factor, begins)
                    value = mix(value + (least >> np.uint64(32)))
                hashes[:, band] = value
            ends = np.arange(0, (len(texts) + 1) * bands, bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(texts)),
                    pa.array(content[0].view(np.int64)),
                    pa.array(content[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64).ravel())),
                ],
                names=["id", "high", "low", "bands"],
            )


@returning_memory
def _set_rows(batches: Iterator[pa.RecordBatch], ngram: int) -> Iterator[pa.RecordBatch]:
    """(id, content hash, distinct n-gram hashes) of the texts with words of a batch (id, text)."""
    tables = HashTables()
    for batch in batches:
        offsets, data = buffers(batch.column(1))
        for first, last in pieces(offsets):
            owner, grams, texts, content = _grams(offsets, data, first, last, ngram, tables)
            order = np.lexsort((grams, owner))
            owner, grams = owner[order], grams[order]
            fresh = np.ones(len(grams), bool)
            fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
            owner, grams = owner[fresh], grams[fresh]
            ends = np.searchsorted(owner, np.r_[texts, last]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(texts)),
                    pa.array(content[0].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(grams.view(np.int64))),
                ],
                names=["id", "text", "grams"],
            )


def candidate_pairs(places: DataFrame, part: int = PART) -> DataFrame:
    """(id, bucket, band, part, low, high): texts dealt to the block pairs of their buckets.

    ``places`` has (id, band, bucket). Blocks ``low`` and ``high`` of a bucket meet in one task.
    Buckets whose texts all share a lower band's bucket hold no new pair.
    """
    buckets = places.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("texts"),
        F.min("band").alias("band"),
        F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    fresh = buckets.filter("texts > 1").groupBy("texts", "x", "y").agg(F.min_by("bucket", "band").alias("bucket"))
    fresh = staged(fresh.select("bucket", F.ceil(F.col("texts") / part).cast("int").alias("parts")), "buckets")
    dealt = places.join(fresh, "bucket").withColumn("part", F.pmod(F.xxhash64("id", "bucket"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    return dealt.select("id", "bucket", "band", "part", other).select(
        "id", "bucket", "band", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )


def _shared_counts(offsets: np.ndarray, grams: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of n-grams that the sets of ``left`` share with those of ``right``."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    _, column, times = np.unique(grams, return_inverse=True, return_counts=True)
    met = np.flatnonzero(times[column] > 1)
    met = met[np.argsort(column[met], kind="stable")]
    owner, column = owner[met], column[met]
    column = np.cumsum(np.r_[False, column[1:] != column[:-1]]) if len(column) else column
    both = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, [first, first + COLUMNS])
        holds = np.zeros((len(offsets) - 1, int(column[high - 1]) - first + 1), np.float32)
        holds[owner[low:high], column[low:high] - first] = 1.0
        both += holds[left] @ holds[right].T
    return both


def _block_links(block: pa.RecordBatch, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, similarity) of the links of a block pair that no lower band's bucket holds."""
    part = block["part"].to_numpy()
    low, high, band = block["low"][0].as_py(), block["high"][0].as_py(), block["band"][0].as_py()
    left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
    bands = block["bands"].flatten().to_numpy().reshape(len(part), -1)
    new = np.triu(np.ones((len(left), len(right)), bool), 1) if low == high else np.ones((len(left), len(right)), bool)
    for lower in range(band):
        new &= bands[left, lower][:, None] != bands[right, lower][None, :]
    some, others = new.any(axis=1), new.any(axis=0)
    new, left, right = new[some][:, others], left[some], right[others]
    if not new.size:
        none = np.empty(0, np.int64)
        return none, none, none.astype(float)
    used = np.unique(np.r_[left, right])
    sets = block["grams"].take(pa.array(used))
    offsets = np.r_[0, np.cumsum(sets.value_lengths().to_numpy())]
    at, to = np.searchsorted(used, left), np.searchsorted(used, right)
    both = _shared_counts(offsets, sets.flatten().to_numpy(), at, to).astype(float)
    size = np.diff(offsets)
    likeness = both / (size[at][:, None] + size[to][None, :] - both)
    a, b = np.nonzero(new & (likeness >= similarity))
    return left[a], right[b], likeness[a, b]


def _groups(a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """The smallest row each row is linked to, over any number of links."""
    label = np.arange(rows)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            return label
        label = least


@returning_memory
def _linked_rows(batches: Iterator[pa.RecordBatch], similarity: float, pairs: bool) -> Iterator[pa.RecordBatch]:
    """Links of rows in the order of bucket, low and high: pairs, or (id, links, one text of its group)."""

    def compared(table: pa.Table):
        block = table.combine_chunks().to_batches()[0]
        a, b, likeness = _block_links(block, similarity)
        if pairs and len(a):
            ends = [block["id"].take(pa.array(rows)) for rows in (np.minimum(a, b), np.maximum(a, b))]
            yield pa.RecordBatch.from_arrays([*ends, pa.array(likeness)], names=["a", "b", "similarity"])
        elif len(a):
            links = np.bincount(np.r_[a, b], minlength=block.num_rows)
            rows = np.flatnonzero(links)
            least = _groups(a, b, block.num_rows)[rows]
            names = block["id"]
            columns = [names.take(pa.array(rows)), pa.array(links[rows]), names.take(pa.array(least))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "links", "near"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = np.stack([table[k].to_numpy().astype(np.int64) for k in ("bucket", "low", "high")])
        begins = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        for first, last in zip(begins[:-1], begins[1:], strict=True):
            yield from compared(table.slice(first, last - first))
        held = table.slice(begins[-1])
    if held is not None:
        yield from compared(held)


def _path_ends(pointers: DataFrame) -> DataFrame:
    """(id, label) from pointers (id, next) to smaller ids: where each path of pointers ends."""
    pointers = staged(pointers, "pointers")
    while True:
        further = pointers.select(F.col("id").alias("next"), F.col("next").alias("label"))
        doubled = pointers.join(further, "next").select("id", "label", (F.col("label") != F.col("next")).alias("moved"))
        doubled = staged(doubled, "pointers")
        if doubled.filter("moved").isEmpty():
            return doubled.select("id", "label")
        pointers = doubled.select("id", F.col("label").alias("next"))


def components(links: DataFrame) -> DataFrame:
    """(id, class): connected components of links (a, b), named by their smallest id.

    Every round each id points to its smallest neighbour, pointers are doubled until they
    reach the end of their paths, and each path becomes one id. Links inside vanish, so
    what is left shrinks from round to round. All state is in written tables.
    """
    edges = staged(links.select("a", "b"), "edges")
    classes = edges.select(F.col("a").alias("id"), F.col("a").alias("class")).limit(0)
    first = True
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("id"), F.least("a", "near").alias("next"))
        merged = _path_ends(near)
        if first:
            classes, first = merged.withColumnRenamed("label", "class"), False
        else:
            moved = merged.withColumnRenamed("id", "class")
            classes = classes.join(moved, "class", "left").select("id", F.coalesce("label", "class").alias("class"))
            classes = staged(classes, "classes")
        edges = (
            edges.join(merged.select(F.col("id").alias("a"), F.col("label").alias("x")), "a")
            .join(merged.select(F.col("id").alias("b"), F.col("label").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges = staged(edges, "edges")
    return classes


def similarity_join(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    ngram: int = NGRAM,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, links, degrees, classes).

    A text is named by a struct of its smallest id and a hash of its words.
    ``members`` has a row (id, text) per row of ``docs`` that has an id and words.
    ``links`` has all verified pairs of texts (a, b, similarity), a < b, with at least
    ``similarity``; they grow with the square of a group and are computed when read.
    ``degrees`` has (id, n_links), ``classes`` (id, class) of the linked texts.
    """
    bands, rows = choose_bands(similarity, recall)
    docs = docs.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text")
    )
    kind = docs.schema["id"].dataType.simpleString()
    signed = docs.mapInArrow(
        functools.partial(_signature_rows, ngram=ngram, bands=bands, rows=rows),
        f"id {kind}, high long, low long, bands array<long>",
    )
    signed = staged(signed, "signatures")
    reps = signed.groupBy("high", "low").agg(F.min("id").alias("least"), F.first("bands").alias("bands"))
    reps = staged(reps.select("high", "low", F.struct(F.col("least").alias("id"), F.col("high").alias("text")).alias("text"), "bands"), "texts")
    members = signed.select("id", "high", "low").join(reps.select("high", "low", "text"), ["high", "low"])
    members = staged(members.select("id", "text"), "members")
    places = reps.select(F.col("text").alias("id"), F.posexplode("bands").alias("band", "bucket"))
    dealt = staged(candidate_pairs(places), "pairs")
    wanted = dealt.select("id").distinct()
    # One plan at every size: the wanted ids grow with the corpus, so they are never broadcast.
    sets = docs.join(wanted.select("id.id").distinct().hint("merge"), "id", "left_semi").mapInArrow(
        functools.partial(_set_rows, ngram=ngram), f"id {kind}, text long, grams array<long>"
    )
    sets = sets.groupBy(F.struct("id", "text").alias("id")).agg(F.first("grams").alias("grams"))
    sets = staged(sets.join(reps.select(F.col("text").alias("id"), "bands"), "id"), "gram-sets")
    keys = ["bucket", "low", "high"]
    blocks = dealt.join(sets, "id").select("id", *keys, "band", "part", "bands", "grams")
    blocks = blocks.repartition(*keys).sortWithinPartitions(*keys, "id")
    name = dealt.schema["id"].dataType.simpleString()
    compared = functools.partial(_linked_rows, similarity=similarity)
    links = blocks.mapInArrow(functools.partial(compared, pairs=True), f"a {name}, b {name}, similarity double")
    found = staged(blocks.mapInArrow(functools.partial(compared, pairs=False), f"id {name}, links long, near {name}"), "links")
    degrees = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    classes = components(found.filter("id <> near").select(F.col("near").alias("a"), F.col("id").alias("b")).distinct())
    return members, links, degrees, classes


def similarity_classes(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """(doc id, class_id, text_id, n_links), a row per row of ``docs`` (per id and text).

    ``class_id`` is the smallest id of the document's class, ``text_id`` the smallest id with
    the same words, ``n_links`` the number of other texts that its text was verified
    to be similar to. Documents without words and rows without an id are linked
    to nothing: their class is their own id, if any. Repeated rows are members of one
    text. An empty table gives an empty result. Other columns are ignored.
    """
    members, _, degrees, found = similarity_join(docs, id_column, **options)
    known = staged(found.join(degrees, "id").withColumnRenamed("id", "text"), "classes")
    placed = members.join(known, "text", "left").select(
        F.col("id").alias(id_column),
        F.coalesce("class.id", "text.id").alias("class_id"),
        F.col("text.id").alias("text_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    wordless = docs.filter(F.col(id_column).isNull() | ~F.coalesce(F.col(options.get("text_column", "text")).rlike(WORD), F.lit(False)))
    alone = wordless.select(
        id_column,
        F.col(id_column).alias("class_id"),
        F.col(id_column).alias("text_id"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return placed.unionByName(alone)


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The document with the smallest id of every class, with the columns of ``docs``.

    Documents without words and rows without an id stay. Of repeated rows one stays.
    """
    classes = similarity_classes(docs, id_column, text_column=text_column, **options)
    first = staged(classes.filter(F.col(id_column) == F.col("class_id")).groupBy(id_column).agg(F.count(F.lit(1)).alias("_rows")), "firsts")
    has_words = F.coalesce(F.col(text_column).rlike(WORD), F.lit(False)) & F.col(id_column).isNotNull()
    kept = docs.filter(has_words).join(first, id_column)
    if first.filter("_rows > 1").isEmpty():
        single = kept.select(*docs.columns)
    else:
        # Rows that share the smallest id: with the same words they are repeats of one document.
        repeated = kept.filter("_rows > 1").withColumn("_words", F.array_join(F.split(F.trim(text_column), f"{SPACE}+"), " "))
        single = (
            kept.filter("_rows = 1")
            .select(*docs.columns)
            .unionByName(repeated.dropDuplicates([id_column, "_words"]).select(*docs.columns))
        )
    return single.unionByName(docs.filter(~has_words))
