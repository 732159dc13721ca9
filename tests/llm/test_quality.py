"""Quality classifier: exact inference on small chains, accuracy on unseen documents."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from tripmart.llm.common import HashTables
from tripmart.llm.quality import CLIP, NAMES, NEIGHBOUR, Chains, good_documents, held_out, line_features, score_documents, train, weighted_share

LABELS = "doc_id long, quality int, toxic int"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    rows = np.array([0] * 4 + [1] + [2] * 6 + [3] * 2)
    good, moves = rng.normal(size=len(rows)), rng.normal(size=(2, 2))
    found, expected_moves = Chains(rows).marginals(good, moves)
    wanted, wanted_moves = np.zeros(len(rows)), np.zeros((2, 2))
    for chain in range(4):
        at = np.flatnonzero(rows == chain)
        total, mass, pairs = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=len(at)):
            score = sum(good[i] for i, s in zip(at, states, strict=True) if s) + sum(moves[a, b] for a, b in itertools.pairwise(states))
            total += np.exp(score)
            mass += np.exp(score) * np.array(states)
            for a, b in itertools.pairwise(states):
                pairs[a, b] += np.exp(score)
        wanted[at], wanted_moves = mass / total, wanted_moves + pairs / total
    assert found == pytest.approx(wanted)
    assert expected_moves == pytest.approx(wanted_moves)


def test_line_features():
    texts = ["", "AB cd!\n\nAB cd! | 12", "", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    rows, length, features = line_features(offsets, data, 0, 4, HashTables())
    assert rows.tolist() == [0, 1, 1, 1, 2, 3]
    assert length.tolist() == [0, 6, 0, 11, 0, 1]
    column = dict(zip(NAMES, features.T, strict=True))
    assert column["upper"].tolist() == [0, 0.5, 0, 0.5, 0, 0]
    assert column["empty"].tolist() == [1, 0, 1, 0, 1, 0]
    assert column["pipe"].tolist() == [0, 0, 0, 0.25, 0, 0]


def test_share_is_weighted_by_length():
    rows, length, good = np.array([0, 0, 1]), np.array([9.0, 29.0, 0.0]), np.array([1.0, 0.0, 0.25])
    assert weighted_share(rows, length, good, 0, 2) == pytest.approx([0.25, 0.25])


def corpus(n, seed):
    rng, texts, labels = random.Random(seed), [], []
    for i in range(n):
        lines = [prose(seed * 10_000 + 50 * i + k, rng.randrange(3, 20)) for k in range(rng.randrange(1, 9))]
        bad = i % 4 == 0
        if bad:
            junk = [lambda w: w + "***", lambda w: w.upper() + "!!", lambda w: w + " |"][i // 4 % 3]
            lines = [" ".join(junk(w) for w in line.split()) if k or len(lines) == 1 else line for k, line in enumerate(lines)]
        texts.append("\n".join(lines))
        labels.append(int(not bad))
    return texts, labels


def test_unseen_documents_and_held_out_rows(spark):
    texts, labels = corpus(400, 1)
    docs = frame(spark, texts)
    table = spark.createDataFrame([(i, q, 0) for i, q in enumerate(labels)], LABELS)
    flags = {r.doc_id: r.h for r in docs.select("doc_id", held_out("doc_id").alias("h")).collect()}
    assert flags == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(400)}
    # Wrong labels on held-out rows must not matter.
    wrong = table.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    model = train(docs, wrong)
    scores = {r.doc_id: r.score for r in score_documents(docs, model).collect()}
    assert all((scores[i] >= 0.3) == bool(labels[i]) for i in range(400) if flags[i])
    again = {r.doc_id: r.score for r in score_documents(docs, train(docs, table)).collect()}
    assert again == scores
    fresh, truth = corpus(200, 2)
    found = {r.doc_id: r.score for r in score_documents(frame(spark, fresh), model).collect()}
    assert sum((found[i] >= 0.3) == bool(truth[i]) for i in range(200)) >= 196


def plain_score(model, text):
    """The score of one document, by hand: features of neighbours, all labellings of its lines, weighting, calibration."""
    data = text.encode()
    _, length, features = line_features(np.array([0, len(data)]), np.frombuffer(data, np.uint8), 0, 1, HashTables())
    scaled = np.clip((features - model.mean) / model.spread, -CLIP, CLIP)
    lines = len(scaled)
    good = []
    for i in range(lines):
        inputs = list(scaled[i])
        for j in (i - 1, i + 1):
            there = 0 <= j < lines
            inputs += [scaled[j][NAMES.index(n)] if there else 0.0 for n in NEIGHBOUR] + [0.0 if there else 1.0]
        good.append(float(np.dot([*inputs, 1.0], model.weights)))
    total, mass = 0.0, np.zeros(lines)
    for states in itertools.product((0, 1), repeat=lines):
        weight = np.exp(sum(g for g, s in zip(good, states) if s) + sum(model.moves[a, b] for a, b in itertools.pairwise(states)))
        total += weight
        mass += weight * np.array(states)
    share = np.clip((mass / total * (length + 1)).sum() / (length + 1).sum(), 1e-4, 1 - 1e-4)
    return 1 / (1 + np.exp(-(model.slope * np.log(share / (1 - share)) + model.shift)))


def test_scores_equal_a_plain_computation(spark):
    texts, labels = corpus(160, 5)
    model = train(frame(spark, texts), spark.createDataFrame([(i, q, 0) for i, q in enumerate(labels)], LABELS))
    asked = [*corpus(40, 6)[0], "", "\n\n", "one line", "é!! | x\n\nB C"]
    found = {r.doc_id: r.score for r in score_documents(frame(spark, asked), model).collect()}
    for i, text in enumerate(asked):
        assert found[i] == pytest.approx(plain_score(model, text), rel=1e-6, abs=1e-9)
    many = frame(spark, ["short line\n" * 200_000 + "x", "short line\n" * 200_000 + "x"])
    scores = {r.score for r in score_documents(many, model).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_odd_rows(spark, odd_texts):
    texts, labels = corpus(100, 3)
    table = spark.createDataFrame([(i, q, 0) for i, q in enumerate(labels)] + [(None, 1, 0), (3, None, 0), (3, 1, 0)], LABELS)
    model = train(frame(spark, texts), table)
    docs = frame(spark, odd_texts).withColumn("score", F.lit("mine"))
    rows = score_documents(docs, model).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if not (r.text or "")}
    assert len(empty) == 1
    kept = good_documents(docs, table)
    assert kept.columns == docs.columns


def test_nothing_to_learn(spark):
    docs = frame(spark, ["a", "b"])
    none = spark.createDataFrame([], LABELS)
    assert train(docs, none) is None
    assert [r.score for r in score_documents(docs, None).collect()] == [0.5, 0.5]
    assert train(frame(spark, []), none) is None and score_documents(frame(spark, []), None).count() == 0
