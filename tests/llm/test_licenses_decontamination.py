"""Licence scan and decontamination against plain computations."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from tripmart.llm.decontamination import RADIUS, benchmark_items, clean_documents, contaminations, multi_index, simhash, weighted_jaccard
from tripmart.llm.licenses import TEMPLATES, Template, license_digest, license_words, scan_licenses, word_weights

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def base(text):
    words, starts, labels = plain_words(text), [], set()
    for phrase, label in PHRASES.items():
        n = len(phrase.split())
        for i in range(len(words) - n + 1):
            if words[i : i + n] == phrase.split():
                starts.append(i)
                labels.add(label)
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(labels))


LICENCES = [
    "All rights reserved. all RIGHTS, reserved cc-by 4.0",
    "cc by cc by cc by", "the GNU General Public License, version 3", "general public general public license",
    "reserved all rights", "ÄLL rights reserved all\x00rights\x7freserved", "all rights\nreserved", "licence CC BY-NC 4.0", "all", "",
]


def test_base_places(spark, odd_texts):
    rng = random.Random(1)
    words = "all rights reserved cc by general public license x y".split()
    texts = LICENCES + [t for _, t in odd_texts] + [" ".join(rng.choices(words, k=60)) for _ in range(40)]
    docs = frame(spark, texts).withColumn("places", F.lit(0)).withColumn("n_words", F.lit("mine"))
    found = {r.doc_id: r for r in license_digest(scan_licenses(docs)).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        assert set(r.base_labels.split(",")) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_notices_need_their_mandatory_phrase(spark):
    texts = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software)",
        "Permission is kindly granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
        "x Permission is hereby granted, free of cost, to any person obtaining one copy of this software and "
        "associated documentation files",
        "Licensed under the Apache License, Version 2.0.",
        "the apache version of a licensed license",
        "Licensed under CC BY-NC 4.0.",
    ]
    rows = {r.doc_id: r for r in license_digest(scan_licenses(frame(spark, texts))).collect()}
    assert [rows[i].labels for i in range(6)] == ["mit", "", "mit", "apache-2.0", "", "cc-by,cc-by-nc"]
    assert rows[0].score == 1.0 and 0.8 <= rows[2].score < 1.0


def plain_places(words, weights):
    """Every place of every template, by trying all starts."""
    found = []
    for t in TEMPLATES:
        n, total = len(t.words), sum(weights[w] for w in t.words)
        offsets = [next(i for i in range(n) if t.words[i : i + len(p)] == p) for p in (tuple(p.split()) for p in t.phrases)]
        for start in range(1 - n, len(words)):
            there = [0 <= start + p < len(words) and words[start + p] == w for p, w in enumerate(t.words)]
            share = sum(weights[w] for w, ok in zip(t.words, there) if ok) / total
            held = all(all(there[o : o + len(p.split())]) for o, p in zip(offsets, t.phrases))
            if (all(there) if t.share >= 1 else held and share >= t.share):
                found.append((t.label, start, start + n, round(share, 9)))
    return sorted(found)


def test_no_place_is_missed(spark):
    """Random edits of every template: words changed, dropped, put in, cut off at either end."""
    rng = random.Random(12)
    texts = ["The program code form is subject to the terms of the Mozilla Public License, v. 2.0"]
    for t in TEMPLATES:
        for _ in range(14):
            words = list(t.words)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(words))
                change = rng.random()
                words[at : at + 1] = [rng.choice(["any", "this", "zebra"])] if change < 0.7 else [] if change < 0.85 else [words[at], "extra"]
                words = words or ["any"]
            cut = rng.randrange(3)
            texts.append(" ".join([*rng.choices(["all", "license", "permission", "the"], k=rng.randrange(4)), *words[cut:]]))
    docs = frame(spark, texts + texts[:3])
    weights = word_weights(docs.select(license_words(F.col("text")).alias("_words")), TEMPLATES)
    rows = scan_licenses(docs).collect()
    for r in rows:
        found = sorted((p.label, p.start, p.end, round(p.share, 9)) for p in r.places)
        assert found == plain_places(plain_words(r.text), weights), r.text
    assert "mpl-2.0" in {p.label for p in rows[0].places}
    digest = {r.doc_id: r for r in license_digest(scan_licenses(docs)).collect()}
    for r in rows:
        assert digest[r.doc_id].labels == ",".join(sorted({p.label for p in r.places}))
        assert digest[r.doc_id].score == round(max((p.share for p in r.places), default=0.0), 6)


def test_places_in_a_long_text(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    text = f"{notice} {prose(3, 30_000)} {notice} {prose(4, 30_000)} all rights reserved"
    row = scan_licenses(frame(spark, [text])).first()
    assert [(p.label, p.start) for p in row.places] == [("reserved", 60_016), ("apache-2.0", 0), ("apache-2.0", 30_008)]


def test_template_with_a_foreign_phrase():
    with pytest.raises(ValueError):
        Template("x", "a b c", ("c a",))


def test_license_scan_of_an_empty_table(spark):
    assert license_digest(scan_licenses(frame(spark, []))).count() == 0


# ------------------------------------------------------------------ decontamination


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def expected(docs, items):
    """Pairs with a window of the item's length at a similarity of 0.8."""
    pairs = set()
    split = [(item, tokens(text)) for item, text in items]
    for doc, text in docs:
        words = tokens(text)
        every = set(shingles(words)) if len(words) >= 5 else set()
        for item, other in split:
            if not other or not words:
                continue
            if len(words) >= 5 and len(other) >= 5 and not every & set(shingles(other)):
                continue
            for start in range(max(1, len(words) - len(other) + 1)):
                a, b = shingles(words[start : start + len(other)]), shingles(other)
                if sum((a & b).values()) / sum((a | b).values()) >= 0.8:
                    pairs.add((doc, item))
                    break
    return pairs


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_planted_items(spark):
    rng = random.Random(2)
    items = [prose(500 + i, 15 + i * 2) for i in range(20)] + ["tiny item", "", None, "a b a b a b a b a b a b"]
    docs = []
    for i in range(80):
        words = prose(i, 20 + i).split()
        if i % 2:
            planted = items[i % 20].split()
            if i % 4 == 1:
                planted[rng.randrange(len(planted))] = "changed"
            if i % 8 == 3:
                planted = [w.upper() + "," for w in planted]
            at = rng.randrange(len(words))
            words[at:at] = planted
        docs.append((i, " ".join(words)))
    docs += [(100, "so tiny, ITEM!"), (101, items[3]), (102, " ".join(items[4].split()[:12])), (103, "a b " * 30), (104, None), (105, "")]
    found = contaminations(frame(spark, docs), bench(spark, items))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected(docs, list(enumerate(items)))


def test_reordered_items(spark):
    """Halves swapped, sentences moved, words changed and left out: the item's shingles stand at other places."""
    rng = random.Random(12)
    items = [prose(700 + i, 40 + i) for i in range(24)]
    docs = []
    for i in range(120):
        words = items[i % 24].split()
        cut = len(words) // 2 if i < 24 else rng.randrange(3, len(words) - 3)
        moved = words[cut:] + words[:cut]
        if i % 3 == 1:
            moved[rng.randrange(len(moved))] = "changed"
        if i % 5 == 2:
            del moved[rng.randrange(len(moved))]
        around = prose(i, 60).split()
        at = rng.randrange(60)
        docs.append((i, " ".join(around[:at] + moved + around[at:])))
    found = contaminations(frame(spark, docs), bench(spark, items))
    wanted = expected(docs, list(enumerate(items)))
    assert len(wanted) > 40
    assert {(r.doc_id, r.item_id) for r in found.collect()} == wanted


def test_an_item_in_a_very_long_text(spark):
    items = [prose(900, 40), prose(901, 25)]
    long = f"{prose(3, 40_000)} {items[0]} {prose(4, 40_000)}"
    found = contaminations(frame(spark, [long, long]), bench(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.similarity) for r in found) == [(0, 0, 40_000, 1.0), (1, 0, 40_000, 1.0)]


def test_clean_documents(spark, odd_texts):
    item = prose(1, 40)
    docs = frame(spark, odd_texts).withColumn("start", F.lit("mine"))
    kept = clean_documents(docs, bench(spark, [item]))
    assert kept.columns == docs.columns
    # Of id 6 only the row with another text stays.
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 5, 6, 8, 9, 10, 11]
    assert sorted((r.text or "") for r in kept.filter("doc_id IS NULL").collect()) == ["", "no id here"]


def test_empty_tables(spark):
    docs = frame(spark, [prose(1, 30)])
    assert contaminations(docs, bench(spark, []).limit(0)).count() == 0
    assert contaminations(frame(spark, []), bench(spark, [prose(1, 30)])).count() == 0
    assert clean_documents(docs, bench(spark, [None, ""])).count() == 1


def test_fingerprints_of_similar_windows_are_near(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        a = [rng.randrange(-(2**63), 2**63) for _ in range(45)]
        b = a[:40] + [rng.randrange(-(2**63), 2**63) for _ in range(5)]
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    far = F.bit_count(simhash(F.col("a")).bitwiseXOR(simhash(F.col("b"))))
    near = df.select((far <= RADIUS).alias("near"), weighted_jaccard(F.col("a"), F.col("b")).alias("j")).collect()
    assert all(r.j == pytest.approx(0.8) for r in near)
    assert sum(r.near for r in near) >= 0.99 * len(near)


def test_fingerprint_is_the_majority_of_bits(spark):
    values = [3, 5, -1]
    value = spark.range(1).select(simhash(F.array(*[F.lit(v).cast("long") for v in values])).alias("f")).first().f
    bits = [sum(v >> k & 1 for v in values) > len(values) / 2 for k in range(64)]
    assert value & (2**64 - 1) == sum(1 << k for k, b in enumerate(bits) if b)


def test_rows_without_id_are_told_apart(spark):
    """Texts of one id, or of none, whose windows have the same start and length."""
    items = [prose(900 + i, 30) for i in range(8)]
    docs = [(None, f"{prose(i, 7)} {item}") for i, item in enumerate(items)] + [(4, f"{prose(i, 9)} {item}") for i, item in enumerate(items)]
    found = contaminations(frame(spark, docs), bench(spark, items)).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.start) for r in found) == [(0, i, 7) for i in range(8)] + [(4, i, 9) for i in range(8)]


def test_the_index_is_made_in_several_tasks(spark):
    bench = spark.createDataFrame([(i, prose(i, 30)) for i in range(20)], "item_id long, text string")
    index = multi_index(benchmark_items(bench, "item_id", "text", 5), RADIUS)
    per_task = index.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) > 1 and sum(r["count"] for r in per_task) == 20 * 4 * sum(bin(m).count("1") <= RADIUS // 4 for m in range(1 << 16))
