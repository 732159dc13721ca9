"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is a long run of token characters inside a word. Features are its
length, its character transitions, how much of it the corpus's frequent words
cover, the path it stands in and the words around it. The forest is trained from
labelled findings: rows of candidates with a label, at most ``train_rows`` different ones.

Where no labelled findings are given, the words in front of a candidate label it (``rule_labels``), and the
forest sees nothing of them (``UNANNOUNCED``): it learns from announced secrets what
secrets look like, and finds those that nothing announces. Announced words that look like
ordinary ones are not held for secrets.

Only DataFrame functions and the DataFrame-based random forest run here.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tripmart.llm.common import SPACE, staged

MIN_LENGTH = 16
TRAIN_ROWS = 20_000
TREES = 30
DEPTH = 6
DICTIONARY = 400
THRESHOLD = 0.5

RUN = f"[A-Za-z0-9_+/\\-]{{{MIN_LENGTH},}}={{0,2}}"
WORD = "(?<![A-Za-z0-9])[A-Za-z]+(?![A-Za-z0-9])"

# Words that announce a credential, and formats that issuers document.
ANNOUNCING = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "key", "auth", "credential", "bearer")
ISSUED = "^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_live_[A-Za-z0-9]{16,}$"

FEATURES = [
    "length", "digits", "uppers", "lowers", "hex", "vowels", "letter_to_digit", "digit_to_letter",
    "lower_to_upper", "upper_to_lower", "same_again", "covered", "slashes", "url", "dots", "announced", "announced_near",
    "assigned", "quoted", "words_around", "words_after", "starts_word",
]
# Features that tell how a candidate is announced, by which the rules label; and the others.
ANNOUNCEMENT = ("announced", "announced_near", "assigned", "quoted", "words_around", "starts_word")
UNANNOUNCED = [f for f in FEATURES if f not in ANNOUNCEMENT]


def frequent_words(docs: DataFrame, text_column: str, size: int = DICTIONARY) -> list[str]:
    """The ``size`` words of four letters or more that most documents have; counted over all texts."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_column), F.lit("[a-z]{4,}"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(size).collect()]


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, word_at, run_at, candidate, prefix, suffix, before, after): a row per run.

    ``word_at`` counts words, ``run_at`` runs within the word; ``before`` and ``after`` are
    three and two neighbouring words.
    """
    has_run = docs.filter(F.col(text_column).rlike(RUN)).select(
        F.col(id_column).alias("id"), F.split(F.col(text_column), f"{SPACE}+").alias("words")
    )
    found = F.filter(
        F.transform("words", lambda w, i: F.when(w.rlike(RUN), F.struct(i.alias("word_at"), w.alias("word")))),
        lambda x: x.isNotNull(),
    )
    placed = F.transform(
        found,
        lambda x: F.struct(
            x["word_at"].alias("word_at"),
            x["word"].alias("word"),
            F.array_join(F.slice("words", F.greatest(x["word_at"] - 2, F.lit(1)), F.least(x["word_at"], F.lit(3))), " ").alias("before"),
            F.array_join(F.slice("words", x["word_at"] + 2, 2), " ").alias("after"),
        ),
    )
    rows = has_run.select("id", F.inline(placed))
    runs = rows.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(RUN), F.lit(0))).alias("run_at", "candidate"))
    return runs.withColumn("_at", F.position(F.col("candidate"), F.col("word"))).select(
        "id",
        "word_at",
        "run_at",
        "candidate",
        F.substring("word", F.lit(1), F.col("_at") - 1).alias("prefix"),
        F.substring("word", F.col("_at") + F.length("candidate"), F.length("word")).alias("suffix"),
        "before",
        "after",
    )


def _rate(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def with_features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """Add the columns of ``FEATURES``, all doubles."""
    lead = F.lower(F.concat_ws(" ", "before", "prefix"))
    announced = "|".join(ANNOUNCING)
    bare = F.lower("candidate")
    rest = F.regexp_replace(bare, "|".join(sorted(dictionary, key=lambda w: (-len(w), w))), "") if dictionary else bare
    values = {
        "length": F.length("candidate"),
        "digits": _rate("[0-9]"),
        "uppers": _rate("[A-Z]"),
        "lowers": _rate("[a-z]"),
        "hex": F.col("candidate").rlike("^[0-9a-f]+$|^[0-9A-F]+$"),
        "vowels": _rate("[aeiouAEIOU]"),
        "letter_to_digit": _rate("(?<=[A-Za-z])[0-9]"),
        "digit_to_letter": _rate("(?<=[0-9])[A-Za-z]"),
        "lower_to_upper": _rate("(?<=[a-z])[A-Z]"),
        "upper_to_lower": _rate("(?<=[A-Z])[a-z]"),
        "same_again": _rate("(.)(?=\\1)"),
        "covered": 1 - F.length(rest) / F.length("candidate"),
        "slashes": F.regexp_count("candidate", F.lit("/")),
        "url": lead.rlike("(https?|ftp)://|www\\.|[/\\\\]$"),
        "dots": F.regexp_count(F.concat("prefix", "suffix"), F.lit("\\.")),
        "announced": lead.rlike(f"({announced})[^a-z0-9]*$"),
        "announced_near": lead.rlike(announced),
        "assigned": lead.rlike("[=:]\\s*[\"']?$"),
        "quoted": F.col("prefix").rlike("[\"']$") & F.col("suffix").rlike("^[\"']"),
        "words_around": F.regexp_count(F.concat_ws(" ", "before", "after"), F.lit(WORD)),
        "words_after": F.regexp_count("after", F.lit(WORD)),
        "starts_word": F.length("prefix") == 0,
    }
    return found.withColumns({name: F.coalesce(values[name].cast("double"), F.lit(0.0)) for name in FEATURES})


def rule_labels(found: DataFrame) -> DataFrame:
    """Findings labelled by what stands in front of them; others are left out.

    1: assigned to a credential word, with a digit in it, or of a format that an issuer documents. 0: nothing around them names a
    credential and nothing is assigned. A secret that nothing announces gets the wrong label; the announced ones
    outweigh it while they are the larger part of those that look like it.
    """
    lead = F.lower(F.concat_ws(" ", "before", "prefix"))
    around = F.lower(F.concat_ws(" ", "before", "prefix", "suffix", "after"))
    names = "|".join(ANNOUNCING)
    assigned = lead.rlike(f"({names})\\s*[=:]\\s*[\"']?$") & F.col("candidate").rlike("[0-9]")
    free = ~around.rlike(names) & ~lead.rlike("[=:]\\s*[\"']?$")
    label = F.when(F.col("candidate").rlike(ISSUED) | assigned, 1.0).when(free, 0.0)
    return found.withColumn("label", label).filter(F.col("label").isNotNull())


def train(
    labelled: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH, features: list[str] = FEATURES
) -> PipelineModel | None:
    """A forest over ``features`` from at most ``train_rows`` labelled findings, half of them of either label; None without both.

    Equal findings count once, so a group of copies does not fill the sample. Of each label those with the
    smallest hashes are taken, ties in the order of their texts. A finding with both labels is left out.
    """
    by = ["candidate", "before", "after"]
    kinds = labelled.groupBy(*FEATURES, *by).agg(F.min("label").alias("label"), F.max("label").alias("_other"))
    distinct = staged(kinds.filter(F.col("label") == F.col("_other")).drop("_other"), "labelled")
    order = [F.xxhash64(*by), *by, *FEATURES]
    halves = [distinct.filter(F.col("label") == label).orderBy(*order).limit(train_rows // 2) for label in (0.0, 1.0)]
    sample = staged(halves[0].unionByName(halves[1]), "findings")
    if len(sample.select("label").distinct().limit(2).collect()) < 2:
        return None
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    vectors = assembler.transform(sample.coalesce(1).sortWithinPartitions(*order))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="sqrt")
    return PipelineModel([assembler, forest.fit(vectors)])


def scan_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    labelled: DataFrame | None = None,
    threshold: float = THRESHOLD,
    dictionary_words: int = DICTIONARY,
) -> DataFrame:
    """(doc id, word_at, run_at, candidate, score, is_secret): a row per candidate of every text.

    ``labelled`` has the columns of ``candidates`` and ``label``; without it the rules
    label. If the findings don't have both labels, every candidate scores 0.5 and counts as
    a secret. NULL and empty texts have no candidates; repeated rows are scanned
    one by one, equal findings (ties) score alike. A very long text is one array of words in its task. An
    empty table gives an empty result. Other columns are ignored.

    Runs of fewer than ``MIN_LENGTH`` characters are no candidates, so short passwords are not found; nor
    are secrets of other characters as a whole: tokens with dots count part by part, key blocks line by line.
    """
    dictionary = frequent_words(docs, text_column, dictionary_words)
    found = staged(with_features(candidates(docs, id_column, text_column), dictionary), "candidates")
    if labelled is None:
        model = train(rule_labels(found), features=UNANNOUNCED)
    else:
        model = train(with_features(labelled, dictionary))
    if model is None:
        scored = found.withColumn("score", F.lit(0.5))
    else:
        scored = model.transform(found).withColumn("score", F.round(vector_to_array("probability")[1], 9))
    return scored.select(
        F.col("id").alias(id_column), "word_at", "run_at", "candidate", "score", (F.col("score") >= threshold).alias("is_secret")
    )


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", mark: str = "[secret]", **options) -> DataFrame:
    """The documents with every secret replaced by ``mark``; rows without an id stay as they are."""
    found = scan_secrets(docs, id_column, text_column, **options).filter("is_secret")
    lists = found.groupBy(F.col(id_column).alias("_id")).agg(F.array_sort(F.collect_set("candidate"), lambda a, b: F.length(b) - F.length(a)).alias("_secrets"))
    joined = docs.join(lists, F.col(id_column) == F.col("_id"), "left")
    clean = F.aggregate(F.coalesce("_secrets", F.array().cast("array<string>")), F.col(text_column), lambda t, s: F.replace(t, s, F.lit(mark)))
    return joined.withColumn(text_column, clean).select(*docs.columns)
