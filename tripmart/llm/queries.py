"""Named queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmart.llm.common import SPACE, crc_of, table
from tripmart.llm.decontamination import contaminations
from tripmart.llm.licenses import license_digest, scan_licenses
from tripmart.llm.lm_score import score_texts
from tripmart.llm.merkle import build_manifest, field, prove, row_digest
from tripmart.llm.mixing import fair_queue
from tripmart.llm.neighbours import nearest
from tripmart.llm.ngram_join import similarity_classes
from tripmart.llm.periods import find_runs
from tripmart.llm.quality import THRESHOLD, held_out, score_documents, train
from tripmart.llm.secrets import scan_secrets
from tripmart.llm.sharding import shard_rows
from tripmart.llm.sql import ORACLES
from tripmart.llm.substrings import remove_repeats
from tripmart.llm.toxicity import THRESHOLD as TOXIC, score_toxicity, train as train_toxicity

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    if function.__name__ in QUERIES:
        raise ValueError(f"two queries are named {function.__name__}")
    QUERIES[function.__name__] = function
    return function


@query
def op1_substring_dedup(spark, sf_dir):
    trimmed = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return trimmed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    scored = score_documents(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@query
def op3_license_scan(spark, sf_dir):
    return license_digest(scan_licenses(table(spark, sf_dir, "documents")))


@query
def op4_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op5_lm_score(spark, sf_dir):
    scored = score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.withColumn("log_score", F.round("log_score", 6))


@query
def op6_sharding(spark, sf_dir):
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    docs = table(spark, sf_dir, "documents").select("doc_id", size.alias("size"), crc_of("text").alias("text_crc32"), "text")
    return shard_rows(docs, shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )


@query
def op7_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))
    return found.withColumn("rank", F.col("rank").cast("int"))


@query
def op8_source_mix(spark, sf_dir):
    mix = fair_queue(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_decontamination(spark, sf_dir):
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_ngram_jaccard(spark, sf_dir):
    return similarity_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score_toxicity(docs, model, keep_text=False).select("doc_id", held_out("doc_id").alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


ROW = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _id_crc():
    """Unsigned crc32 of the decimal id; NULL for a row without one."""
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))


@query
def op12_merkle_manifest(spark, sf_dir):
    # Every fifth row is verified with its text in lower case instead of the one in the manifest.
    docs = table(spark, sf_dir, "documents").select(*ROW)
    changed = F.coalesce(_id_crc() % 5 == 0, F.lit(False))
    text = F.when(changed, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    docs = docs.withColumn("now", text)
    claim = F.when(changed, row_digest(ROW, {"text": field("now")})).otherwise(row_digest(ROW))
    proven = prove(build_manifest(docs, ROW, claim=claim))
    return proven.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def _repeated_tail():
    """The text; in every tenth document the words from some place on repeat a few of them."""
    words = F.col("words")
    n = F.size(words)
    part = F.floor(F.col("h") / 10)
    begin = part % n
    period = 1 + F.floor((n - begin) / (3 + part % 8))
    repeated = F.transform(
        words, lambda word, i: F.when(i < begin, word).otherwise(F.get(words, (begin + (i - begin) % period).cast("int")))
    )
    return F.when((F.col("h") % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(F.col("text"))


@query
def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", _id_crc().alias("h"))
    tenth = F.when(F.col("h") % 10 == 0, F.col("text"))
    words = F.regexp_extract_all(F.coalesce(tenth, F.lit("")), F.lit(f"{SPACE.replace('[', '[^')}+"), F.lit(0))
    changed = docs.withColumn("words", words).select("doc_id", _repeated_tail().alias("text"))
    found = find_runs(changed)
    # The longest run: a larger one of smaller start or period comes first.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("a"), (-r["period"]).alias("b")))
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (
        found.withColumn("best", best)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("best.a")).alias("start"),
            F.col("best.length").alias("length"),
            (-F.col("best.b")).alias("period"),
            F.floor(1000 * F.col("best.length") / (-F.col("best.b"))).cast("long").alias("exponent_milli"),
            F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
