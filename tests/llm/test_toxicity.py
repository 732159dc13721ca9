"""Compression distance: its parts by hand, its accuracy on texts it has not seen."""

import random

import numpy as np
import pytest

from tests.llm.conftest import frame, prose
from tripmart.llm.toxicity import (
    CHUNK_CHARS,
    Lengths,
    fit,
    marking_words,
    score_toxicity,
    train,
    windows,
)

BAD = ["grumblefoot", "snarkwit", "vilegob", "Mudbrain"]


def texts(count, seed, share=0.3):
    """Ordinary texts, some with a few bad words in places of their own."""
    rng = random.Random(seed)
    found = []
    for i in range(count):
        words = prose(seed * 10_000 + i, rng.randint(20, 300), 3_000).split()
        label = int(rng.random() < share)
        for _ in range(max(1, len(words) // 40) * label):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ",", "."]))
        found.append((" ".join(words), label))
    return found


@pytest.fixture(scope="module")
def model():
    given = texts(600, 1)
    return fit([t for t, _ in given], np.array([y for _, y in given], float), np.ones(len(given)))


def test_windows_hold_every_word_once():
    text = prose(3, 100).replace(" ", "\n ", 3)
    assert b" ".join(windows(text)).decode().split() == text.split()
    assert [len(w.split()) for w in windows(text)] == [16] * 6 + [4]
    assert list(windows("")) == list(windows(" \n")) == []
    long = "word " * (CHUNK_CHARS // 4)
    assert sum(len(w.split()) for w in windows(long)) == CHUNK_CHARS // 4


def test_lengths_follow_the_dictionary():
    plain, marked = Lengths(b" some ordinary words here "), Lengths(b" grumblefoot  some ordinary words here ")
    parts = [b" some ordinary words ", b" you grumblefoot of some ordinary words here ", b"x"]
    gain = plain.of(parts) - marked.of(parts)
    assert gain[1] >= 5 and abs(gain[0]) <= 1 and gain[2] == 0


def test_marking_words_need_contexts_of_their_own():
    copies = ["one rareword two three four five"] * 50
    toxic = [f"{prose(i, 20)} snarkwit {prose(i + 99, 20)}" for i in range(12)]
    assert marking_words(toxic + copies, [prose(i, 60) for i in range(40)]) == {"snarkwit"}


def test_unseen_texts(model):
    given = texts(400, 2)
    scores = np.array(list(model.scores(t for t, _ in given)))
    labels = np.array([y for _, y in given])
    assert (scores[labels == 1] >= 0.5).mean() >= 0.9
    assert (scores[labels == 0] < 0.5).mean() >= 0.95
    assert ((scores >= 0) & (scores <= 1)).all()


def labelled(spark, given):
    docs = frame(spark, [t for t, _ in given])
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(given)], "doc_id long, toxic int")


def test_spark_gives_the_same_scores(spark, model, odd_texts):
    docs = frame(spark, odd_texts).withColumnRenamed("lang", "score")
    rows = score_toxicity(docs, model).collect()
    assert [r.score for r in rows] == list(model.scores((t or "") for _, t in odd_texts))
    assert rows[0].score == rows[1].score  # NULL and empty


def test_training_leaves_out_what_is_held_out(spark):
    import zlib

    given = texts(300, 3)
    docs, labels = labelled(spark, given)
    first = train(docs, labels)
    swapped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, (_, y) in enumerate(given)]
    again = train(docs, spark.createDataFrame(swapped, "doc_id long, toxic int"))
    assert first.toxic == again.toxic and np.array_equal(first.weights, again.weights)
    few = train(docs, labels, sample_rows=20, sample_bytes=20_000)
    assert few is not None and len(few.ordinary) <= 20_000


def test_odd_labels_and_empty_tables(spark, model, odd_texts):
    docs = frame(spark, odd_texts)
    one = spark.createDataFrame([(1, 1), (6, 1), (None, 0), (7, None)], "doc_id long, toxic int")
    assert train(docs, one) is None
    two = spark.createDataFrame([(6, 1), (7, 0), (7, 0), (8, 0), (9, 1), (1, 0), (2, 1)], "doc_id long, toxic int")
    assert {r.score for r in score_toxicity(docs, None).collect()} == {0.0}
    assert score_toxicity(docs, train(docs, two)).count() == len(odd_texts)
    assert score_toxicity(frame(spark, []), model).count() == 0
