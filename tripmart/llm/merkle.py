"""Merkle manifest of a dataset: a digest tree per group of rows, and one tree over the groups.

Sixteen consecutive nodes become their digest, level by level, while several nodes remain.
A tree is stored as aligned subtrees ("blocks") of three levels of digests, one row each, whose
nodes lie in van Emde Boas order: the levels are cut at half height, the top part comes
first, then its subtrees from left to right, each laid out in the same way. ``address`` computes
where a node lies; building a block and reading the siblings of its leaves both go through it.
The roots of the blocks are the leaves of the next tier of blocks, so a group of any size is a
few tiers of blocks of at most 4,096 leaves, and no task holds a group.

Proofs run the other way. The one block at the top hands each of its leaves the siblings on
its way up; that leaf is the root of a block below, which adds its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripmart.llm.common import staged

FANOUT = 16
HEIGHT = 3  # levels of digests in a block
WIDTH = FANOUT**HEIGHT  # leaves of a block
BUNDLE_ROWS = 4 * WIDTH  # rows of blocks that share a task's group

_DIGEST = 32
_STEPS = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
_STEPS_DDL = "array<struct<left: binary, right: binary>>"


# ------------------------------------------------------------------------- one block


def full_size(levels: int) -> int:
    """Nodes of a complete tree of so many levels of nodes."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where nodes of one depth (0: root) lie in the van Emde Boas order of a complete tree."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    bottom, below = levels - top, depth - top
    wide = FANOUT**below
    return full_size(top) + index // wide * full_size(bottom) + address(bottom, below, index % wide)


def level_counts(leaves: int, height: int) -> list[int]:
    """Nodes of each level of a block, from its leaves to its root."""
    counts = [leaves]
    for _ in range(height):
        counts.append(-(-counts[-1] // FANOUT))
    return counts


def _level(nodes: np.ndarray, height: int, level: int, count: int) -> str:
    """The digests of one level, from left to right, as one text."""
    at = address(height + 1, height - level, np.arange(count))
    return nodes[at].tobytes().hex()


def _join(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def build_block(leaves: np.ndarray, height: int) -> np.ndarray:
    """All nodes over some leaves (rows of 32 bytes), in van Emde Boas order; absent ones are zero."""
    nodes = np.zeros((full_size(height + 1), _DIGEST), np.uint8)
    nodes[address(height + 1, height, np.arange(len(leaves)))] = leaves
    step = 2 * _DIGEST * FANOUT
    for level, count in enumerate(level_counts(len(leaves), height)[1:], 1):
        below = _level(nodes, height, level - 1, level_counts(len(leaves), height)[level - 1])
        made = b"".join(_join(below[i * step : (i + 1) * step]) for i in range(count))
        nodes[address(height + 1, height - level, np.arange(count))] = np.frombuffer(made, np.uint8).reshape(-1, _DIGEST)
    return nodes


class Block:
    """A stored block: siblings of its leaves, level by level."""

    def __init__(self, nodes: bytes, leaves: int, height: int):
        stored = np.frombuffer(nodes, np.uint8).reshape(-1, _DIGEST)
        self.counts = level_counts(leaves, height)
        self.levels = [_level(stored, height, k, self.counts[k]) for k in range(height)]

    def steps(self, leaf: int) -> list[tuple[str, str]]:
        """The siblings left and right of each node on the way from a leaf to the root."""
        found = []
        size = 2 * _DIGEST
        for digests in self.levels:
            run = leaf // FANOUT
            cut = size * FANOUT * run
            found.append((digests[cut : size * leaf], digests[size * (leaf + 1) : cut + size * FANOUT]))
            leaf = run
        return found


# -------------------------------------------------------------------------- groups


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, _DIGEST)


def _each_block(rows: pa.Table) -> Iterator[pa.Table]:
    """The blocks of a bundle, each sorted by position."""
    if not rows.num_rows:
        return
    rows = rows.sort_by([("tree", "ascending"), ("place", "ascending")]).combine_chunks()
    trees = rows["tree"].combine_chunks().dictionary_encode().indices.to_numpy()
    block = rows["place"].to_numpy() // WIDTH
    cuts = np.flatnonzero((np.diff(trees) != 0) | (np.diff(block) != 0)) + 1
    for low, high in zip(np.r_[0, cuts], np.r_[cuts, rows.num_rows], strict=True):
        yield rows.slice(low, high - low)


def _build(rows: pa.Table) -> pa.Table:
    found = []
    for block in _each_block(rows):
        height = block["height"][0].as_py()
        nodes = build_block(_bytes(block["digest"]), height)
        place = block["place"][0].as_py() // WIDTH
        found.append((block["tree"][0].as_py(), place, block["n"][0].as_py(), height, block.num_rows, nodes.tobytes(), nodes[0].tobytes()))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    columns = zip(*found, strict=True) if found else [[]] * len(kinds)
    names = ["tree", "place", "n", "height", "leaves", "nodes", "digest"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


_BLOCKS = "tree string, place long, n long, height int, leaves int, nodes binary, digest binary"


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The siblings on the way from each leaf of some blocks to the top of their tree."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row["nodes"], row["leaves"], row["height"])
            above = row["steps"] or []
            first = row["place"] * WIDTH
            steps = [
                [{"left": bytes.fromhex(a), "right": bytes.fromhex(b)} for a, b in block.steps(i)] + above
                for i in range(row["leaves"])
            ]
            places = pa.array(range(first, first + row["leaves"]), pa.int64())
            trees = pa.array([row["tree"]] * row["leaves"], pa.string())
            yield pa.RecordBatch.from_arrays([trees, places, pa.array(steps, _STEPS)], names=["tree", "place", "steps"])


@dataclass
class Forest:
    """The blocks of all tiers of several trees, and each tree's root."""

    tiers: list[DataFrame]
    roots: DataFrame  # tree, digest


def _height(n: Column) -> Column:
    """Levels of digests that a block of a tree of ``n`` nodes has."""
    return sum(((n > FANOUT**k).cast("int") for k in range(HEIGHT)), F.lit(0))


def _bundle(block: Column, rows: int) -> Column:
    """Several blocks that are worked on together, so that small trees don't cost a group each."""
    bundles = max(1, math.ceil(rows / BUNDLE_ROWS))
    return F.pmod(F.xxhash64("tree", block), F.lit(bundles)).alias("bundle")


def _block_of() -> Column:
    return F.floor(F.col("place") / WIDTH)


def plant(nodes: DataFrame, rows: int, name: str) -> Forest:
    """Build trees over nodes (tree, place, n, digest): ``place`` counts from 0 to ``n`` - 1."""
    tiers, roots = [], None
    while True:
        bundled = nodes.withColumn("height", _height(F.col("n"))).withColumn("bundle", _bundle(_block_of(), rows))
        built = staged(bundled.groupBy("bundle").applyInArrow(lambda rows: _build(rows), _BLOCKS), f"{name}-{len(tiers)}")
        tiers.append(built)
        done = built.filter(F.col("n") <= WIDTH).select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        nodes = built.filter(F.col("n") > WIDTH).select(
            "tree", "place", F.ceil(F.col("n") / WIDTH).cast("long").alias("n"), "digest"
        )
        rows = nodes.count()
        if not rows:
            return Forest(tiers, roots)


def _upper_steps(forest: Forest, tier: int, tops: DataFrame) -> DataFrame:
    """For each block of a tier, the siblings above its root; ``tops`` (tree, steps) has those above the roots."""
    blocks = forest.tiers[tier]
    single = blocks.filter(F.col("n") <= WIDTH).join(tops, "tree", "left")
    if tier + 1 == len(forest.tiers):
        return single
    above = _upper_steps(forest, tier + 1, tops)
    given = above.select("tree", "place", "leaves", "height", "nodes", "steps").mapInArrow(
        _extend, f"tree string, place long, steps {_STEPS_DDL}"
    )
    several = blocks.filter(F.col("n") > WIDTH).join(given, ["tree", "place"], "left")
    return single.select(*several.columns).unionByName(several)


# ------------------------------------------------------------------------- rows


def field(column: str) -> Column:
    """A value with its length in bytes in front, or ``-`` for NULL."""
    text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(columns: Sequence[str], instead: dict[str, Column] | None = None) -> Column:
    """Digest of a row's columns, as 32 bytes; ``instead`` replaces the field of some."""
    fields = [(instead or {}).get(c, field(c)) for c in columns]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def ranked(rows: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each tree in an order: adds ``place`` (from 0) and ``n``, the tree's rows.

    Rows are range-sorted over all trees at once and written, so the place of a row is its
    place in its file plus what the files before hold of its tree: one small row per tree and file.
    """
    sorted_rows = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    written = staged(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), name)
    written = written.withColumn("_file", F.shiftright("_at", 33))
    counts = written.groupBy(tree, "_file").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    ahead = Window.partitionBy(tree).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        tree,
        "_file",
        (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(tree)).alias("n"),
    )
    numbered = written.join(offsets, [tree, "_file"]).withColumn("place", F.col("_at") + F.col("_shift"))
    return numbered.drop("_at", "_file", "_shift")


def _prove(rows: pa.Table, blocks: pa.Table) -> pa.Table:
    """Proof and recomputed root of each row; ``claim`` is the digest the row has now."""
    stored = {(b["tree"], b["place"]): b for b in blocks.to_pylist()}
    parts = []
    for part in _each_block(rows):
        key = part["tree"][0].as_py(), part["place"][0].as_py() // WIDTH
        row = stored[key]
        block = Block(row["nodes"], row["leaves"], row["height"])
        above = [(s["left"].hex(), s["right"].hex()) for s in row["steps"] or []]
        tail = "".join(a + b for a, b in above)
        proofs, folded = [], []
        first = key[1] * WIDTH
        for place, claim in zip(part["place"].to_pylist(), part["claim"].to_pylist(), strict=True):
            own = block.steps(place - first)
            proofs.append(hashlib.sha256(("".join(a + b for a, b in own) + tail).encode()).hexdigest())
            digest = claim.hex()
            for left, right in (*own, *above):
                digest = hashlib.sha256((left + digest + right).encode()).hexdigest()
            folded.append(digest)
        subroot = pa.array([row["subroot"].hex()] * part.num_rows, pa.string())
        digests = pa.array([d.hex() for d in part["digest"].to_pylist()], pa.string())
        keys = [part[c] for c in part.column_names if c.startswith("key")]
        names = [c for c in part.column_names if c.startswith("key")]
        parts.append(
            pa.table(
                [*keys, digests, subroot, pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                names=[*names, "leaf", "subroot", "proof_sha256", "folded_root"],
            )
        )
    return pa.concat_tables(parts)


@dataclass
class Manifest:
    """The trees over a table: ``leaves`` (key, tree, place, digest, claim), their forest, and the one over the groups."""

    leaves: DataFrame
    groups: Forest
    top: Forest | None
    tops: DataFrame | None  # tree, its place among the groups, its subroot
    root: str | None
    rows: int


def build_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    key: str = "doc_id",
    claim: Column | None = None,
) -> Manifest:
    """Digest all rows and build the tree of each group and the one over the groups.

    A leaf is the digest of a row's ``columns``. Leaves of a group ascend by ``key`` (NULL
    first), rows with equal keys by their digest; repeated rows are leaves of their own. Groups
    ascend by their UTF-8 bytes, the NULL group first. ``claim`` is a second digest that each row
    is to be verified with, the leaf itself if it is left out. NULL and empty values are told
    apart; texts of any length are digested whole. An empty table has no root. Other
    columns of ``docs`` are not read.
    """
    leaf = row_digest(columns)
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), tree.alias("tree"), leaf.alias("digest"), (leaf if claim is None else claim).alias("claim"))
    rows = staged(rows, "leaves")
    leaves = staged(ranked(rows, "tree", ["key", "digest", "claim"], "ordered"), "numbered")
    count = leaves.count()
    if not count:
        return Manifest(leaves, Forest([], leaves.select("tree", "digest")), None, None, None, 0)
    groups = plant(leaves.select("tree", "place", "n", "digest"), count, "blocks")
    roots = groups.roots.select(F.lit("").alias("all"), "tree", "digest")
    tops = staged(ranked(roots, "all", ["tree"], "subroots"), "groups")
    trees = tops.count()
    top = plant(tops.select(F.col("all").alias("tree"), "place", "n", "digest"), trees, "top")
    root = top.roots.first()["digest"]
    return Manifest(leaves, groups, top, tops, bytes(root).hex(), count)


def prove(manifest: Manifest) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the digest of all siblings from the row's run up to the root;
    ``folded_root`` is the root computed from the row's claim and those siblings, and
    ``verified`` says whether it is the root. One row per leaf; none for an empty table.
    """
    added = "leaf string, subroot string, proof_sha256 string, folded_root string"
    kind = manifest.leaves.schema["key"].dataType.simpleString()
    if manifest.root is None:
        empty = manifest.leaves.select("key", *[F.lit("").alias(c.split()[0]) for c in added.split(", ")])
        return empty.withColumns({"root": F.lit(""), "verified": F.lit(True)})
    over = _upper_steps(manifest.top, 0, manifest.top.roots.select("tree", F.lit(None).cast(_STEPS_DDL).alias("steps")))
    given = over.select("tree", "place", "leaves", "height", "nodes", "steps").mapInArrow(
        _extend, f"tree string, place long, steps {_STEPS_DDL}"
    )
    subroots = manifest.tops.select("place", F.col("tree").alias("group"), F.col("digest").alias("subroot"))
    tops = staged(given.join(subroots, "place").select(F.col("group").alias("tree"), "steps", "subroot"), "tops")
    blocks = _upper_steps(manifest.groups, 0, tops.select("tree", "steps")).join(tops.select("tree", "subroot"), "tree")
    stored = blocks.select(
        "tree", "place", "leaves", "height", "nodes", "steps", "subroot", _bundle(F.col("place"), manifest.rows)
    )
    leaves = manifest.leaves.select("key", "tree", "place", "digest", "claim", _bundle(_block_of(), manifest.rows))
    proven = leaves.groupBy("bundle").cogroup(stored.groupBy("bundle")).applyInArrow(
        lambda rows, blocks: _prove(rows, blocks), f"key {kind}, {added}"
    )
    return proven.withColumns({"root": F.lit(manifest.root), "verified": F.col("folded_root") == F.lit(manifest.root)})
