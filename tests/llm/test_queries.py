"""All queries on the smallest tables: against their SQL, or their columns and counts."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.conftest import frame
from tests.llm.test_licenses_decontamination import expected as leaks
from tests.llm.test_ngram_join import expected as near
from tripmart.llm.queries import ORACLES, QUERIES
from tripmart.llm.quality import good_documents

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    names = entry_points.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    found = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(r[names.index(c)] for c in columns) for r in answer.fetchall()), key=repr)
    assert found == wanted


def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_near_copies(spark, duck):
    rows = QUERIES["op10_ngram_jaccard"](spark, SMALL).collect()
    assert {r.doc_id: r.class_id for r in rows} == near(documents(duck))


def test_leaks(spark, duck):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    rows = QUERIES["op9_decontamination"](spark, SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == leaks(documents(duck), items)


def test_neighbours_recall(spark, duck):
    vectors = dict(duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    found = {}
    for r in QUERIES["op7_nearest_neighbours"](spark, SMALL).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in (v for v in vectors if v % 20 == 0):
        scores = sorted(((-math.fsum(a * b for a, b in zip(vectors[q], x, strict=True)), v) for v, x in vectors.items() if v != q))
        hits += len(found[q] & {v for _, v in scores[:20]})
        total += 20
    assert hits >= 0.9 * total


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_labelled_quality(spark):
    """On the larger tables: the smallest have too few bad documents to learn from."""
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{LARGER}/labels.parquet'").fetchall())
    rows = QUERIES["op2_quality"](spark, LARGER).collect()
    assert len(rows) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    unseen = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in unseen) >= 0.9 * len(unseen)
    for kind in (0, 1):
        of_kind = [p for p, y in unseen if y == kind]
        assert sum(p == kind for p in of_kind) >= 0.7 * len(of_kind)


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_labelled_toxicity(spark):
    """Most documents are ordinary, so both kinds are counted apart."""
    truth = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{LARGER}/labels.parquet'").fetchall())
    rows = QUERIES["op11_toxicity"](spark, LARGER).collect()
    assert len(rows) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    unseen = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    toxic = [p for p, y in unseen if y == 1]
    ordinary = [p for p, y in unseen if y == 0]
    assert sum(toxic) >= 0.6 * len(toxic)
    assert sum(ordinary) <= 0.05 * len(ordinary)


def test_pipeline(spark, duck):
    """The stages' decisions, followed by plain code where it can."""
    docs = documents(duck)
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {r.doc_id for r in good_documents(source, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    left = [(i, t) for i, t in docs if i in good]
    classes = near(left)
    left = [(i, t) for i, t in left if classes[i] == i]
    hit = {i for i, _ in leaks(left, items)}
    left = [(i, t) for i, t in left if i not in hit]
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} <= {i for i, _ in left}
    # The mix takes 150 % of all words, so nearly every document goes in.
    words = {i: len(t.split()) for i, t in left}
    taken = sum(words[r.doc_id] for r in rows)
    assert 1.45 * sum(words.values()) <= taken <= 1.75 * sum(words.values())
    counts = [sum(r.shard == s for r in rows) for s in range(16)]
    assert max(counts) - min(counts) <= 1


def test_stages_take_odd_and_empty_tables(spark, odd_texts, tmp_path):
    for name, texts in (("odd", odd_texts), ("empty", [])):
        folder = tmp_path / name
        frame(spark, texts).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        rows = corpus_pipeline.run(spark, str(folder)).count()
        assert rows == 0 if not texts else rows > 0
