"""Substring dedup against a plain computation."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from tripmart.llm.substrings import remove_repeats

WINDOW = 13


def expected(rows):
    """{row number: (n_words, n_removed, kept text)} by comparing all windows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    least = defaultdict(lambda: float("inf"))
    for (doc, _), ws in zip(rows, words, strict=True):
        for i in range(len(ws) - WINDOW + 1):
            gram = tuple(ws[i : i + WINDOW])
            if doc is not None:
                least[gram] = min(least[gram], doc)
    result = []
    for (doc, _), ws in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(ws) - WINDOW + 1):
            if doc is not None and least[tuple(ws[i : i + WINDOW])] < doc:
                gone.update(range(i, i + WINDOW))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        result.append((doc, len(ws), len(gone), kept))
    return sorted(result, key=repr)


def found(spark, rows):
    result = remove_repeats(frame(spark, rows)).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in result), key=repr)


def test_odd_rows(spark, odd_texts):
    assert found(spark, odd_texts) == expected(odd_texts)


@pytest.mark.parametrize("seed", range(3))
def test_planted_passages(spark, seed):
    passages = [prose(100 + k, 13 + 9 * k) for k in range(4)]
    texts = []
    for i in range(60):
        parts = [prose(1000 * seed + i, 5 + i % 30)]
        if i % 3:
            parts += [passages[i % 4], prose(2000 * seed + i, 7)]
        if i % 7 == 0:
            parts += [" ".join(passages[1].split()[4:20])]
        texts.append((997 - i * (1 if seed else -1), " ".join(parts)))
    assert found(spark, texts) == expected(texts)


def test_repetitive_text_and_twelve_words(spark):
    twelve = prose(9, 12)
    texts = ["a b " * 40, "a b " * 60, twelve, twelve, f"{twelve} z", f"{twelve} z"]
    assert found(spark, texts) == expected(list(enumerate(texts)))


def test_spans_and_clashing_columns(spark):
    texts = [prose(1, 20), f"{prose(2, 3)} {prose(1, 20)}"]
    docs = frame(spark, texts).withColumn("n_words", F.lit("mine")).withColumn("key", F.lit(1))
    second = remove_repeats(docs).filter("doc_id = 1").first()
    assert (second.n_words, [tuple(s) for s in second.removed], second.key) == (23, [(3, 23)], 1)


def test_empty_table(spark):
    docs = frame(spark, [])
    assert remove_repeats(docs).count() == 0


def test_digest_is_of_the_kept_text(spark):
    row = remove_repeats(frame(spark, ["b\ta  c"])).select(F.sha2("kept_text", 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"b a c").hexdigest()
