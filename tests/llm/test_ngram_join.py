"""The Jaccard join against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from tripmart.llm.ngram_join import choose_bands, components, one_of_each, similarity_classes


def grams(text):
    words = (text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def expected(rows):
    """{id: smallest id of its class} with links at 0.8 between all pairs."""
    parent = {doc: doc for doc, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(doc, grams(text)) for doc, text in rows]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and len(x & y) / len(x | y) >= 0.8:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc: root(doc) for doc, _ in rows}


def edited(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_copies_and_near_copies(spark):
    rng = random.Random(3)
    texts = [prose(i, 30 + i) for i in range(40)]
    for base in range(12):
        texts += [edited(texts[base], rng, base % 3) for _ in range(1 + base % 5)]
    big = prose(77, 200)
    texts += [edited(big, rng, 2) for _ in range(80)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    result = similarity_classes(frame(spark, texts))
    assert {r.doc_id: r.class_id for r in result.collect()} == expected(rows)


def test_large_groups_in_parts(spark):
    """Buckets cut into parts are still joined."""
    from tripmart.llm import ngram_join

    rng = random.Random(4)
    big = prose(5, 300)
    texts = [edited(big, rng, 1) for _ in range(60)]
    before = ngram_join.candidate_pairs.__defaults__
    ngram_join.candidate_pairs.__defaults__ = (7,)
    try:
        classes = {r.class_id for r in similarity_classes(frame(spark, texts)).collect()}
    finally:
        ngram_join.candidate_pairs.__defaults__ = before
    assert classes == {0}


def test_all_links_of_a_large_group(spark):
    """More texts than a block, about half of the pairs linked, among texts just below the threshold."""
    rng = random.Random(6)
    big = prose(8, 140)
    texts = [edited(big, rng, 1 + i % 3) for i in range(1100)] + [edited(big, rng, 6) for _ in range(150)]
    sets = [grams(t) for t in texts]
    names = {g: i for i, g in enumerate(sorted(set().union(*sets)))}
    holds = np.zeros((len(texts), len(names)), np.float32)
    for row, found in enumerate(sets):
        holds[row, [names[g] for g in found]] = 1
    both, size = holds @ holds.T, holds.sum(axis=1)
    # Equal word sequences are one text, so they are no pair.
    linked = (both / (size[:, None] + size[None, :] - both) >= 0.8) & (np.array(texts)[:, None] != np.array(texts)[None, :])
    result = {r.doc_id: r for r in similarity_classes(frame(spark, texts)).collect()}
    got, wanted = np.array([result[i].n_links for i in range(len(texts))]), linked.sum(axis=1)
    assert (got <= wanted).all() and got.sum() >= 0.995 * wanted.sum()
    assert 0.2 < linked.mean() < 0.9
    label = np.arange(len(texts))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(texts)).min(axis=1))
        if (least == label).all():
            break
        label = least
    assert [result[i].class_id for i in range(len(texts))] == label.tolist()


def test_odd_rows(spark, odd_texts):
    result = similarity_classes(frame(spark, odd_texts)).collect()
    assert len(result) == len(odd_texts)
    classes = {}
    for r in result:
        classes.setdefault(r.doc_id, set()).add(r.class_id)
    assert classes[1] == {1} and classes[2] == {2} and classes[3] == {3} and classes[None] == {None}
    assert classes[7] == {6} and classes[9] == {8}
    assert all(r.n_links == 0 for r in result)


def test_one_of_each_keeps_one(spark, odd_texts):
    docs = frame(spark, odd_texts).withColumn("class_id", F.lit("mine"))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    without = [(i, t) for i, t in odd_texts if i is None or not (t or "").split()]
    assert all(rows.count(r) == odd_texts.count(r) for r in without)
    assert sorted(r for r in rows if r[0] == 6) == sorted([odd_texts[6], odd_texts[8]])
    assert not [r for r in rows if r[0] in (7, 9)]


def test_short_texts_and_empty_table(spark):
    result = {r.doc_id: r.class_id for r in similarity_classes(frame(spark, ["a b", "a  b", "b a", "a b c"])).collect()}
    assert result == {0: 0, 1: 0, 2: 2, 3: 3}
    assert similarity_classes(frame(spark, [])).count() == 0
    assert one_of_each(frame(spark, [])).count() == 0


def test_long_chain_is_one_component(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    labels = {r["id"]: r["class"] for r in components(links).collect()}
    assert labels == {i: 0 for i in range(201)}


def test_bands_reach_the_recall():
    bands, rows = choose_bands(0.8, 0.999, 144)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 144
