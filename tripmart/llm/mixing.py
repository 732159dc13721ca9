"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, gone through again
while its target asks for more. What is queued is the single token: its virtual finish
time is the number of its source's tokens up to and with it, divided by the source's target.
The mix is the order of finish times over all sources, cut off at the total budget.

The targets add up to the budget, so the cut falls at time 1 up to a token a source: of a source with
target t, exactly the first floor(t) tokens finish by then. How many of a document's tokens these
are follows from the tokens ahead of it, a running total per source, without sorting
single tokens; ``taken`` is that number. (Cutting the order of whole documents instead would miss
a target by up to the longest document.) ``mixed`` sorts the whole documents by finish time over all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripmart.llm.common import crc_of, hash_buckets, repeated_keys, row_key, running_totals, staged

# The contract's mix: weights in turn, budget as a share of all tokens, repeats at most.
WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
ROWS_PER_SLICE = 4_000

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source_no, source, source_size, weight, target), a row per source.

    ``sizes`` has a row (source, source_size) per source. Sources in code point
    order, NULL last, take the weights in turn. A source's target is its share
    of the budget by weight, but ``max_epochs`` times its size at most; what is
    cut off goes to the others by weight. With sources in the order of limit over
    weight the common level is found directly: it is the first one that does not
    exceed its own source's ratio. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1)
    rated = (
        sizes.withColumn("source_no", number.cast("int"))
        .withColumn("weight", weight.cast("long"))
        .withColumn("_limit", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_limit") / F.col("weight"))
    )
    order = Window.orderBy("_ratio", "source_no")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total * F.lit(float(budget_share)) - F.coalesce(F.sum("_limit").over(ahead), F.lit(0))) / F.sum(
        "weight"
    ).over(behind)
    leveled = rated.withColumn("_level", level)
    reached = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "source_no", "_level")))
    common = reached.over(Window.partitionBy())["_level"]
    target = F.least(F.col("_limit").cast("double"), F.col("weight") * F.coalesce(common, F.lit(float("inf"))))
    return leveled.select("source_no", "source", "source_size", "weight", target.alias("target"))


def fair_queue(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights=WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS,
    rows_per_slice: int = ROWS_PER_SLICE,
    keep_text: bool = True,
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target``, ``taken``, ``copies``, ``start``, ``finish``.

    ``taken`` counts the words the mix takes of the document, repeats included: a
    source's words taken are its target, rounded down. ``copies`` is how often
    the document starts before the cut, so how often whole documents go into a mix
    that does not split them. ``start`` and ``finish`` are the virtual times between which its first
    copy is served; each further copy follows ``source_size / target`` later. NULL and empty texts have
    size 0: nothing is taken of them and
    they go into the mix once at most. NULL is a source of its own. Repeated
    rows are separate documents, interchangeable in the queue. A very long text is a document like
    others; the cut may fall inside it. An empty table gives an empty result. Columns of
    ``docs`` named like a result are replaced. Without ``keep_text`` the text is dropped, and words are
    counted once: their numbers are stored instead.
    """
    added = ["size", "source_size", "target", "taken", "copies", "start", "finish"]
    docs = docs.drop(*[c for c in docs.columns if c in added and c not in (id_column, text_column, source_column)])
    sized = (
        docs.withColumn("size", word_count(F.col(text_column)))
        .withColumn("_crc", crc_of(text_column))
        .withColumn("_key", row_key(id_column, "_crc"))
    )
    kept = docs.columns
    if not keep_text:
        kept = [c for c in kept if c != text_column]
        sized = staged(sized.drop(text_column), "sizes")
    sources = source_targets(
        sized.groupBy(F.col(source_column).alias("source")).agg(F.sum("size").alias("source_size")),
        weights,
        budget_share,
        max_epochs,
    ).select("source_no", F.col("source").alias("_source"), "source_size", "target")
    numbered = sized.join(sources, F.col(source_column).eqNullSafe(F.col("_source"))).drop("_source")
    buckets = hash_buckets(sized.count(), rows_per_slice)
    ties = [id_column, "_crc"]
    repeated = repeated_keys(sized, "_key", ties, rows_per_slice)
    queued = running_totals(
        numbered, "source_no", "_key", "size", ties, buckets, "_ahead", "_all", repeated, rows_per_slice
    )
    goal = F.floor("target").cast("long")
    taken, copies = F.lit(0).cast("long"), F.lit(0)
    for epoch in range(max_epochs):
        left = goal - (F.col("_ahead") + F.col("source_size") * epoch)
        taken = taken + F.greatest(F.lit(0).cast("long"), F.least(left, F.col("size")))
        again = (left > 0) & ((F.col("size") > 0) | F.lit(epoch == 0))
        copies = copies + again.cast("int")

    def time(words: Column) -> Column:
        return F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))

    return (
        queued.withColumn("taken", taken)
        .withColumn("copies", copies)
        .withColumn("start", time(F.col("_ahead")))
        .withColumn("finish", time(F.col("_ahead") + F.col("size")))
        .select(*kept, *added)
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: whole documents, each as often as the mix starts it, in the order
    of virtual finish times (a global range sort), with the columns of ``docs``."""
    rows = fair_queue(docs, **options)
    epochs = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_epoch")
    repeated = rows.filter(F.col("copies") > 0).select("*", epochs)
    time = F.when(F.col("target") > 0, F.col("finish") + (F.col("_epoch") - 1) * F.col("source_size") / F.col("target"))
    return repeated.withColumn("_time", time).orderBy("_time").select(*docs.columns)
