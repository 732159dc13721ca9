"""Digest trees against a plain computation."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame
from tripmart.llm import merkle
from tripmart.llm.merkle import Block, address, build_block, build_manifest, full_size, prove

ROW = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    fields = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    return digest("".join(fields))


def climb(nodes):
    """Levels of a tree, from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def siblings(levels, place):
    found = []
    for level in levels[:-1]:
        first = place // 16 * 16
        run = level[first : first + 16]
        found.append(("".join(run[: place - first]), "".join(run[place - first + 1 :])))
        place //= 16
    return found


def expected(rows, changed=()):
    """(key, leaf, subroot, root, proof, folded, verified) of rows in the order of ROW."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        levels[name] = climb([leaf(r) for r in trees[name]])
    top = climb([levels[name][-1][0] for name in names])
    result = []
    for g, name in enumerate(names):
        for place, row in enumerate(trees[name]):
            steps = siblings(levels[name], place) + siblings(top, g)
            folded = leaf((*row[:4], row[4].lower())) if row[0] in changed else leaf(row)
            for left, right in steps:
                folded = digest(left + folded + right)
            proof = digest("".join(left + right for left, right in steps))
            result.append((row[0], leaf(row), levels[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(result, key=repr)


def found(df):
    names = ("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_addresses(levels):
    """Every node has its own place; a subtree cut at half height is one stretch."""
    places = [address(levels, d, np.arange(16**d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(full_size(levels)))
    top = levels // 2
    if top:
        assert sorted(np.concatenate(places[:top]).tolist()) == list(range(full_size(top)))
        size = full_size(levels - top)
        for j in (0, 16**top - 1):
            inside = np.concatenate([places[top + d][j * 16**d : (j + 1) * 16**d] for d in range(levels - top)])
            assert sorted(inside.tolist()) == list(range(full_size(top) + j * size, full_size(top) + (j + 1) * size))


@pytest.mark.parametrize("count, height", [(1, 0), (1, 3), (2, 1), (16, 1), (17, 2), (256, 2), (257, 3), (4095, 3), (4096, 3)])
def test_blocks(count, height):
    leaves = [digest(str(i)) for i in range(count)]
    nodes = build_block(np.array([list(bytes.fromhex(x)) for x in leaves], np.uint8), height)
    block = Block(nodes.tobytes(), count, height)
    levels = [leaves]
    for _ in range(height):
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    assert nodes[0].tobytes().hex() == levels[-1][0]
    for place in {0, count // 2, count - 1}:
        steps = block.steps(place)
        assert steps == siblings([*levels[:-1], [""]], place)[:height]


def test_odd_rows(spark, odd_texts):
    docs = frame(spark, odd_texts, ["b", None, "", "a", "ä", "=", "Z"])
    rows = [tuple(r[c] for c in ROW) for r in docs.collect()]
    assert found(prove(build_manifest(docs))) == expected(rows)


def rows_of(spark, sizes):
    """Sources of these many rows."""
    rows = [(i * 7, f"Text {i}", "en", f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, [(r[0], r[3], r[2], r[4], r[1]) for r in rows]


def test_sizes_of_groups(spark):
    docs, rows = rows_of(spark, [1, 2, 16, 17, 256, 257, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1])
    assert found(prove(build_manifest(docs.repartition(5)))) == expected(rows)


def test_several_tiers(spark, monkeypatch):
    """Blocks of one level: as many tiers as levels, in both trees."""
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "WIDTH", 16)
    monkeypatch.setattr(merkle, "BUNDLE_ROWS", 64)
    docs, rows = rows_of(spark, [4100, 300, *[1] * 20])
    claim = F.when(F.col("doc_id") == 7, merkle.row_digest(ROW, {"text": merkle.field("low")})).otherwise(merkle.row_digest(ROW))
    manifest = build_manifest(docs.withColumn("low", F.lower("text")), claim=claim)
    assert [t.count() for t in manifest.groups.tiers] == [257 + 19 + 20, 17 + 2, 2 + 1, 1]
    assert len(manifest.top.tiers) == 2
    assert found(prove(manifest)) == expected(rows, changed={7})


def test_large_group(spark):
    """More leaves than one block holds."""
    docs, rows = rows_of(spark, [4097, 3])
    assert found(prove(build_manifest(docs))) == expected(rows)


def test_empty_table_and_clashing_names(spark):
    manifest = build_manifest(frame(spark, []))
    assert manifest.root is None and prove(manifest).count() == 0
    docs, rows = rows_of(spark, [3])
    for name in ("tree", "place", "n", "digest", "claim", "key", "bundle", "_at", "leaf"):
        docs = docs.withColumn(name, F.lit("x"))
    assert found(prove(build_manifest(docs))) == expected(rows)
