"""Benchmark decontamination by SimHash of item-sized windows.

A window of a document is as long as a benchmark item. Only windows in which enough
word shingles, at whatever places, occur in benchmark items of that length are
fingerprinted: a window with fewer cannot reach the similarity with any of them,
so leaving it out loses nothing. Fingerprints meet in a multi-index:
64 bits in four blocks. Two fingerprints that differ in at most ``radius`` bits
differ in at most ``radius // 4`` bits of one block at least, and the index holds
every item under all block values within that distance, so no pair within the
radius is missed. Candidates are verified exactly: weighted Jaccard similarity of
their shingles, each weighted by how often it occurs.

Everything is DataFrame code. The places of shared shingles are shuffled first, without
texts; then only documents that have such windows are cut into them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tripmart.llm.common import staged
from tripmart.session import BROADCAST_LIMIT_BYTES

SHINGLE = 5
SIMILARITY = 0.8
# Bits in which fingerprints of similar windows may differ. At similarity 0.8 the
# mean is 10 with a deviation of 3; 19 is more than three deviations above.
RADIUS = 19
BLOCKS = 4
BLOCK_BITS = 16
LANE_BITS = 32
MAX_FAST_KEYS = BROADCAST_LIMIT_BYTES // 64


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits: case, punctuation and spacing don't count."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.array_remove(words, "")


def _grams(words: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words."""
    def at(i):
        return F.xxhash64(*[F.get(words, i + k) for k in range(n)])

    starts = F.sequence(F.lit(0), F.size(words) - n)
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= n, F.transform(starts, at)).otherwise(none)


def window_shingles(words: Column, shingle: int = SHINGLE) -> Column:
    """Shingle hashes of a window; one shorter than a shingle is a single shingle."""
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(F.size(words) >= shingle, _grams(words, shingle)).otherwise(short)


def simhash(shingles: Column) -> Column:
    """64-bit fingerprint: each bit is the majority of that bit over the shingles.

    Two counters of 32 bits share one addition.
    """
    mask = F.lit(1 | 1 << LANE_BITS).cast("long")
    half = F.size(shingles) / F.lit(2)
    bits = []
    for bit in range(LANE_BITS):
        lanes = _lane_sum(shingles, bit, mask)
        low = lanes.bitwiseAND(F.lit((1 << LANE_BITS) - 1).cast("long"))
        high = F.shiftrightunsigned(lanes, LANE_BITS)
        bits.append(F.when(low > half, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
        top = bit + LANE_BITS
        value = (1 << top) - (1 << 64) if top == 63 else 1 << top
        bits.append(F.when(high > half, F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _lane_sum(shingles: Column, bit: int, mask: Column) -> Column:
    def add(total, h):
        return total + F.shiftrightunsigned(h, bit).bitwiseAND(mask)

    return F.aggregate(shingles, F.lit(0).cast("long"), add)


def _block(fingerprint: Column, block: int) -> Column:
    cut = F.shiftrightunsigned(fingerprint, BLOCK_BITS * block)
    return cut.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger counts of all shingles."""
    def count(array, x):
        return F.size(F.filter(array, lambda y: y == x))

    def smaller(total, x):
        return total + F.least(count(a, x), count(b, x))

    shared = F.aggregate(F.array_intersect(a, b), F.lit(0), smaller)
    return shared / (F.size(a) + F.size(b) - shared)


def benchmark_items(benchmark: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """(item_id, n, shingles, fingerprint, text_key) of all items that have words."""
    return (
        benchmark.select(F.col(id_column).alias("item_id"), plain_words(F.col(text_column)).alias("_w"))
        .filter(F.size("_w") > 0)
        .select("item_id", F.size("_w").alias("n"), window_shingles(F.col("_w"), shingle).alias("shingles"))
        .withColumn("fingerprint", simhash(F.col("shingles")))
        .withColumn("text_key", F.xxhash64("n", "shingles"))
    )


def multi_index(items: DataFrame, radius: int) -> DataFrame:
    """(block, value, text_key, fingerprint): every block value within the block's share of the radius."""
    share = radius // BLOCKS
    masks = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda m: F.bit_count(m) <= share)
    blocks = F.array(*[F.struct(F.lit(b).alias("block"), _block(F.col("fingerprint"), b).alias("own")) for b in range(BLOCKS)])
    keyed = items.dropDuplicates(["text_key"]).select("text_key", "fingerprint", F.inline(blocks))
    # Few rows become thousands each: a number of tasks keeps them from being made in one.
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    masked = keyed.repartition(tasks, "text_key", "block").withColumn("mask", F.explode(masks))
    return masked.withColumn("value", F.col("own").bitwiseXOR(F.col("mask").cast("long"))).drop("mask", "own")


def _starts(places: Column, shared: Column, grams: Column, last: Column) -> Column:
    """Starts up to ``last`` of windows of ``grams`` shingles that hold at least ``shared`` of the sorted ``places``.

    A start belongs to the first place that is not before it, so none is given twice.
    """
    def after(i):
        place = F.get(places, i)
        low = F.greatest(F.lit(0), F.coalesce(F.get(places, i - 1) + 1, F.lit(0)), F.get(places, i + shared - 1) - grams + 1)
        high = F.least(place, last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    enough = F.size(places) >= shared
    return F.when(enough, F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - shared), after))).otherwise(F.array().cast("array<int>"))


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc id, item_id, start, n_words, similarity): windows of documents that repeat an item.

    ``start`` counts words from 0. A pair of document and item has one row, its most
    similar window (the first, among equals). NULL and empty texts have no
    window; items without words match nothing; a text shorter than an item is
    compared whole. Repeated rows of a document count once; repeated items are
    reported under each id, NULL included. Empty tables give an empty result. Other columns are
    ignored.
    """
    items = benchmark_items(benchmark, item_id, item_text, shingle)
    parts = items.select("n", F.explode("shingles").alias("gram"))
    parts = parts.withColumn("size", F.least(F.lit(shingle), F.col("n")))
    wanted = parts.groupBy("gram").agg(F.collect_set("n").alias("lengths"))
    sizes = [r["size"] for r in parts.select("size").distinct().collect()]
    known = wanted.count()

    # A row is named by its id and its text: rows without an id, or of one id, may differ in text.
    key = ["_k", "_l"]
    texts = docs.select(
        F.col(id_column).alias("_id"),
        F.xxhash64(id_column, text_column).alias("_k"),
        F.xxhash64(F.lit(1), id_column, text_column).alias("_l"),
        F.col(text_column).alias("_text"),
    )
    worded = texts.select(*key, plain_words(F.col("_text")).alias("_w"))
    hashed = []
    for size in sorted(sizes):
        if size == shingle:
            values = _grams(F.col("_w"), size)
        else:
            values = F.transform(
                F.sequence(F.lit(0), F.greatest(F.size("_w") - size, F.lit(0))),
                _joined(size),
            )
        hashed.append(worded.filter(F.size("_w") >= size).select(*key, F.size("_w").alias("words"), F.posexplode(values).alias("at", "gram")))
    if not hashed:
        hashed = [worded.select(*key, F.size("_w").alias("words"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("gram")).limit(0)]
    positions = reduce(DataFrame.unionByName, hashed)
    # The benchmark's shingles are broadcast only within a checked number; beyond it, both sides are shuffled.
    lookup = F.broadcast(wanted) if known <= MAX_FAST_KEYS else wanted
    hits = positions.join(lookup, "gram").select(*key, "words", "at", F.explode("lengths").alias("n"))
    held = hits.groupBy(*key, "words", "n").agg(F.array_sort(F.collect_set("at")).alias("places"))
    # Shingles of an item and of a window; at the least similarity they share this part of both.
    whole = F.greatest(F.lit(1), F.col("n") - (shingle - 1))
    grams = F.least(whole, F.greatest(F.lit(1), F.col("words") - (shingle - 1)))
    shared = F.greatest(F.lit(1), F.ceil((whole + grams) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)).cast("int"))
    last = F.greatest(F.col("words") - F.col("n"), F.lit(0))
    starts = held.select(*key, "n", _starts(F.col("places"), shared, grams, last).alias("starts")).filter(F.size("starts") > 0)
    windows = (
        texts.join(staged(starts, "starts"), key)
        .select("_id", plain_words(F.col("_text")).alias("_w"), "n", "starts")
        .select("_id", "_w", "n", F.explode("starts").alias("start"))
        .select("_id", "start", "n", F.slice("_w", F.col("start") + 1, F.col("n")).alias("_window"))
        .withColumn("_s", window_shingles(F.col("_window"), shingle))
        .withColumn("_f", simhash(F.col("_s")))
    )
    keys = F.array(*[F.struct(F.lit(b).alias("block"), _block(F.col("_f"), b).alias("value")) for b in range(BLOCKS)])
    # Merge join: the index is far larger than its estimate, so it must not be broadcast.
    met = (
        windows.select("_id", "start", "n", "_s", "_f", F.inline(keys))
        .join(multi_index(items, radius).hint("merge"), ["block", "value"])
        .filter(F.bit_count(F.col("_f").bitwiseXOR(F.col("fingerprint"))) <= radius)
        .select("_id", "start", "n", "_s", "text_key")
    )
    near = (
        met.join(items.select("text_key", "item_id", "shingles"), "text_key")
        .withColumn("similarity", weighted_jaccard(F.col("_s"), F.col("shingles")))
        .filter(F.col("similarity") >= similarity)
    )
    best = F.max_by(F.struct("start", F.col("n").alias("n_words"), "similarity"), F.struct("similarity", -F.col("start"), "n"))
    return (
        near.groupBy("_id", "item_id").agg(best.alias("_best")).select(F.col("_id").alias(id_column), "item_id", "_best.*")
    )


def _joined(size: int):
    def at(i):
        return F.xxhash64(F.array_join(F.slice("_w", i + 1, size), " "))

    return at


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents without any contamination; each row is judged by its own text."""
    name = F.concat_ws(" ", F.coalesce(F.col(id_column).cast("string"), F.lit("none")), F.xxhash64("text"))
    marked = docs.withColumn("_key", name)
    found = contaminations(marked.select("_key", "text"), benchmark, id_column="_key", **options)
    return marked.join(found.select("_key").distinct(), "_key", "left_anti").select(*docs.columns)
