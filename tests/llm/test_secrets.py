"""Secret scan: candidates by a plain search, forest on held-out findings."""

import random
import re

from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from tripmart.llm.secrets import ANNOUNCEMENT, RUN, UNANNOUNCED, candidates, redact, rule_labels, scan_secrets, train, with_features


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdef") for _ in range(n))


def findings(seed, n=120):
    """(text, secret or not) with one candidate each."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        around = prose(seed * 1000 + i, 12).split()
        kind = i % 6
        if kind == 0:
            value, label = f'token = "{hexes(rng, 40)}"', 1
        elif kind == 1:
            value, label = "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)), 1
        elif kind == 2:
            value, label = f"password={hexes(rng, 18)}", 1
        elif kind == 3:
            value, label = "4" + "".join(rng.choices("0123456789", k=15)), 0
        elif kind == 4:
            value, label = "ungleichberechtigungen" + rng.choice(["", "en", "s"]), 0
        else:
            value, label = "-".join(hexes(rng, k) for k in (8, 4, 4, 4, 12)), 0
        around.insert(6, value)
        rows.append((" ".join(around), label))
    return rows


def test_candidates(spark, odd_texts):
    texts = [t for _, t in odd_texts] + [t for t, _ in findings(1, 30)] + [f"a={'x1' * 10},b={'y2' * 10}=="]
    expected = []
    for i, text in enumerate(texts):
        for at, word in enumerate(re.split(r"[\x20\x09-\x0D]+", text or "")):
            expected += [(i, at, k, m) for k, m in enumerate(re.findall(RUN, word))]
    rows = candidates(frame(spark, texts)).collect()
    assert sorted((r.id, r.word_at, r.run_at, r.candidate) for r in rows) == sorted(expected)
    last = [r for r in rows if r.id == len(texts) - 1]
    assert [(r.prefix[-2:], r.suffix[:1]) for r in sorted(last, key=lambda r: r.run_at)] == [("a=", ","), ("b=", "")]


def test_unseen_findings(spark):
    """Trained on labelled findings, tested on others."""
    train, test = findings(2), findings(3)
    marked = candidates(frame(spark, [t for t, _ in train]))
    labels = spark.createDataFrame([(i, float(y)) for i, (_, y) in enumerate(train)], "id long, label double")
    found = scan_secrets(frame(spark, [t for t, _ in test]), labelled=marked.join(labels, "id"), dictionary_words=50)
    verdicts = {r.doc_id: r.is_secret for r in found.collect()}
    right = sum(verdicts[i] == bool(y) for i, (_, y) in enumerate(test))
    assert right >= 0.97 * len(test)


def test_rules_label_where_no_labels_are_given(spark):
    rows = findings(4)
    found = {r.doc_id: r for r in scan_secrets(frame(spark, [t for t, _ in rows])).collect()}
    assert all(found[i].is_secret == bool(y) for i, (_, y) in enumerate(rows))
    again = {r.doc_id: r.score for r in scan_secrets(frame(spark, [t for t, _ in rows])).collect()}
    assert again == {i: r.score for i, r in found.items()}


def test_planted_findings_without_an_announcement(spark):
    """Precision and recall on secrets that nothing announces, and on announced words that are none."""
    rng = random.Random(11)
    rows = findings(8, 360)
    for i in range(60):
        around = prose(9000 + i, 12).split()
        value, label = [
            (hexes(rng, 40), 1), (f'secret = "ungleichberechtigung{"aeiou"[i % 5]}"', 0), (f"password: verantwortungen{'aeiou'[i % 5]}", 0),
        ][i % 3]
        around.insert(5, value)
        rows.append((" ".join(around), label))
    docs = frame(spark, [t for t, _ in rows])
    found = {r.doc_id: r.is_secret for r in scan_secrets(docs).collect()}
    planted = [(found[i], bool(y)) for i, (_, y) in enumerate(rows) if i >= 360]
    caught = sum(a and b for a, b in planted)
    assert caught >= 0.9 * 20 and caught >= 0.9 * sum(a for a, _ in planted)


def test_the_forest_does_not_see_what_labels_it(spark):
    """A candidate is a secret by its looks, whatever stands in front of it."""
    value = hexes(random.Random(12), 40)
    texts = [t for t, _ in findings(9, 60)] + [f'w1x w2x w3x token = "{value}" w4x w5x', f"w1x w2x w3x seen on {value} w4x w5x"]
    scores = {r.doc_id: r.score for r in scan_secrets(frame(spark, texts)).collect() if r.candidate == value}
    assert scores[60] >= 0.5 and scores[61] >= 0.5
    assert not set(UNANNOUNCED) & set(ANNOUNCEMENT)


def test_nothing_to_learn_and_empty_tables(spark, odd_texts):
    assert scan_secrets(frame(spark, [])).count() == 0
    odd = scan_secrets(frame(spark, odd_texts).withColumn("candidate", F.lit("mine"))).collect()
    assert [(r.doc_id, r.candidate, r.score, r.is_secret) for r in odd] == [(11, "x" * 50_000, 0.5, True)]


def test_redact(spark):
    rows = findings(5, 30)
    docs = frame(spark, [t for t, _ in rows] + [None, ""])
    clean = {r.doc_id: r.text for r in redact(docs).collect()}
    assert len(clean) == 32 and clean[30] is None and clean[31] == ""
    assert all(("[secret]" in clean[i]) == bool(y) for i, (_, y) in enumerate(rows))


def test_copies_do_not_fill_the_sample(spark):
    """A group of copies larger than the sample counts as one finding; each label has its half."""
    rows = findings(6, 60)
    copies = [rows[0][0]] * 300 + [rows[3][0]] * 300
    found = with_features(candidates(frame(spark, copies + [t for t, _ in rows])), [])
    model = train(rule_labels(found), train_rows=40)
    scored = {r.id - 600: r.prediction for r in model.transform(found).collect() if r.id >= 600}
    assert sum(scored[i] == y for i, (_, y) in enumerate(rows)) >= 57
    assert train(rule_labels(found.filter("id < 300")), train_rows=40) is None


def test_a_secret_twice_in_a_text_and_in_repeated_rows(spark):
    text = f"token = {'a1' * 12} and token = {'a1' * 12} again"
    rows = candidates(frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.id, r.word_at) for r in rows) == [(1, 2), (1, 2), (1, 6), (1, 6), (2, 2), (2, 6)]
    given = findings(7)
    docs = frame(spark, [t for t, _ in given] + [text, text])
    scores = {(r.doc_id, r.word_at): r.score for r in scan_secrets(docs).collect()}
    assert scores[120, 2] == scores[121, 2] and scores[120, 6] == scores[121, 6]
