"""Nearest neighbours against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import neighbours
from tripmart.llm.neighbours import _hadamard, choose_probes, nearest, octave_classes, padded_size, rotations_per_key

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d=32, seed=0, scale=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = (centres[rng.integers(0, 12, n)] + 0.6 * rng.normal(size=(n, d))).astype(np.float32)
    if scale:
        x *= rng.uniform(0.2, 3.0, (n, 1)).astype(np.float32)
    return x


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], SCHEMA)


def exact(x, ids, k):
    scores = (x[ids].astype(float)) @ x.astype(float).T
    scores[np.arange(len(ids)), ids] = -np.inf
    return {i: [int(j) for j in np.lexsort((np.arange(len(x)), -row))[: min(k, len(x) - 1)]] for i, row in zip(ids, scores, strict=True)}


def answers(found):
    lists = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        lists.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(lists[r.query_id])
    return lists


@pytest.mark.parametrize("scale", [False, True])
def test_recall(spark, scale):
    x = vectors(3000, scale=scale)
    df = table(spark, x).cache()
    found = nearest(df, df.filter("vec_id % 20 = 0"), block_rows=500, block_queries=20)
    got, wanted = answers(found), exact(x, np.arange(0, 3000, 20), 20)
    hits = sum(len(set(got[q]) & set(w)) for q, w in wanted.items())
    assert hits >= 0.9 * sum(len(w) for w in wanted.values())
    for r in found.limit(50).collect():
        assert r.score == pytest.approx(float(x[r.query_id].astype(float) @ x[r.vec_id].astype(float)), abs=1e-12)


@pytest.mark.parametrize("norms", ["outlier", "lognormal"])
def test_recall_if_norms_differ(spark, norms):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "outlier":
        x[1] *= 5
    else:
        x *= rng.lognormal(0, 1, (4000, 1))
    x = x.astype(np.float32)
    df = table(spark, x).cache()
    got, wanted = answers(nearest(df, df.filter("vec_id % 20 = 0"))), exact(x, np.arange(0, 4000, 20), 20)
    hits = sum(len(set(got[q]) & set(w)) for q, w in wanted.items())
    assert hits >= 0.93 * sum(len(w) for w in wanted.values())


def random_units(n, d=64, seed=8):
    x = np.random.default_rng(seed).normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def candidate_share(monkeypatch, tmp_path):
    """Counts the pairs that the blocks compare, in files that every worker can append to."""
    compared = neighbours.nearest_in_block

    def counted(queries, rows, k):
        with open(tmp_path / "pairs", "a") as file:
            file.write(f"{queries.num_rows * rows.num_rows}\n")
        return compared(queries, rows, k)

    monkeypatch.setattr(neighbours, "nearest_in_block", counted)
    return lambda: sum(map(int, (tmp_path / "pairs").read_text().split()))


@pytest.mark.parametrize(("n", "bucket_rows", "most"), [(500, 16_384, 1.6), (20_000, 16_384, 0.75), (3_000, 4, 0.6)])
def test_every_table_is_searched_by_its_index(spark, monkeypatch, tmp_path, n, bucket_rows, most):
    """Random directions, the hardest case, from the smallest table on; ``most``: pairs compared, repeats in several tables included."""
    x = random_units(n)
    df = table(spark, x).cache()
    asked = np.arange(0, n, max(20, n // 40))
    pairs = candidate_share(monkeypatch, tmp_path)
    got = answers(nearest(df, df.filter(F.col("vec_id").isin(asked.tolist())), bucket_rows=bucket_rows))
    wanted = exact(x, asked, 20)
    hits = sum(len(set(got[q]) & set(w)) for q, w in wanted.items())
    assert hits >= 0.9 * sum(len(w) for w in wanted.values())
    assert 0 < pairs() <= most * n * len(asked)


def test_probes_follow_the_number_of_rows():
    numbers = [choose_probes(n, 20, 64, 8) for n in (200, 2_000, 50_000, 10**6, 10**9)]
    assert numbers == sorted(numbers, reverse=True) and numbers[0] > 4 * numbers[-1]
    assert choose_probes(50_000, 20, 64, 8, recall=0.99) > choose_probes(50_000, 20, 64, 8, recall=0.9)
    # With keys of two rotations a large table compares a small share of its rows.
    assert 1 - (1 - choose_probes(10**8, 20, 64, 8, 2) / 128**2) ** 8 < 0.05
    assert [rotations_per_key(n, 128) for n in (0, 10**6, 10**7, 10**9, 10**12)] == [1, 1, 2, 3, 3]
    assert [padded_size(n) for n in (1, 2, 3, 64, 65)] == [1, 2, 4, 64, 128]


def test_octaves_that_are_searched_whole():
    assert octave_classes({}) == (set(), 0)
    assert octave_classes({0: 500}) == (set(), 2)
    assert octave_classes({0: 1, 3: 900, 4: 5_000, 5: 10}) == ({0, 3}, 6)
    assert octave_classes({0: 1, 3: 1_500, 4: 5_000}) == ({0}, 6)


def test_all_candidates_if_fewer(spark):
    x = vectors(15)
    df = table(spark, x)
    got = answers(nearest(df, df.filter("vec_id % 5 = 0"), tables=1, recall=0.1))
    assert got == exact(x, np.arange(0, 15, 5), 20)


def test_ties_go_to_smaller_ids(spark):
    x = np.repeat(vectors(3), 40, axis=0)
    df = table(spark, x)
    got = answers(nearest(df, df.filter("vec_id in (0, 50, 119)"), block_rows=11))
    assert got == exact(x, np.array([0, 50, 119]), 20)


def test_unusable_vectors_take_no_part(spark):
    good = [[1.0, 0.0, 1.0], [0.5, 1.0, 0.0], [1.0, 1.0, 1.0]]
    bad = [None, [0.0, 0.0, 0.0], [1.0, None, 1.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0], [1.0], []]
    rows = [(i, v, 0) for i, v in enumerate(good + bad)] + [(None, [1.0, 2.0, 3.0], 0), (1, [0.5, 1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("bucket", F.lit("mine"))
    got = answers(nearest(df, df))
    assert got == {0: [2, 1], 1: [2, 0], 2: [0, 1]}


def test_empty_tables(spark):
    df = table(spark, vectors(5))
    assert nearest(df.limit(0), df).count() == 0
    assert nearest(df, df.limit(0)).count() == 0


def test_rotation_keeps_lengths():
    x = vectors(7, 64).astype(float)
    assert np.linalg.norm(_hadamard(x), axis=1) == pytest.approx(np.linalg.norm(x, axis=1))
