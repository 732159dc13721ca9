"""Runs of words against a search over all periods."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import frame, prose
from tripmart.llm.periods import WaveletMatrix, find_runs, runs_of


def brute(words):
    """All maximal stretches of six words or more whose smallest period fits four times."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            smaller = any(all(x == y for x, y in zip(part, part[p:])) for p in range(1, q))
            if j > i and length >= max(6, 4 * q) and not smaller:
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def check(documents):
    borders = np.cumsum([0, *(len(d) for d in documents)])
    found = runs_of(np.array([w for d in documents for w in d], np.int64), borders)
    assert [tuple(r) for r in found.tolist()] == [(i, *r) for i, d in enumerate(documents) for r in brute(d)]


letters = st.lists(st.integers(0, 2), max_size=60)
repeated = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 5)).map(
    lambda t: (t[0] * t[1])[: max(1, len(t[0]) * t[1] - t[2])]
)
documents = st.lists(st.lists(st.one_of(letters, repeated), max_size=4).map(lambda p: sum(p, [])), max_size=4)


@settings(max_examples=400, deadline=None)
@given(documents)
def test_against_all_periods(given_documents):
    check(given_documents)


def test_known_words():
    fibonacci = [0], [0, 1]
    for _ in range(9):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    check([fibonacci[1], [1] * 300, [1, 2] * 100 + [1], [], [3] * 5, [3] * 6, list(range(50)), ([1] * 7 + [2]) * 9])


@given(st.lists(st.integers(0, 2**16), min_size=1, max_size=80, unique=True), st.data())
@settings(max_examples=100, deadline=None)
def test_range_neighbours(values, data):
    values = np.argsort(np.argsort(values))
    low = data.draw(st.integers(0, len(values) - 1))
    high = data.draw(st.integers(low + 1, len(values)))
    part = values[low:high]
    pick = int(data.draw(st.sampled_from(part.tolist())))
    before, after = WaveletMatrix(values).neighbours(np.array([low]), np.array([high]), np.array([pick]))
    assert before[0] == max(part[part < pick], default=-1)
    assert after[0] == min(part[part > pick], default=-1)


def found(df):
    return sorted(
        ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()), key=repr
    )


def test_odd_texts(spark, odd_texts):
    texts = [
        *odd_texts,
        (20, "a b " * 4),
        (20, "a b " * 4),
        (21, "\x0ba\tb\na b\x0c a b a  b x"),
        (22, "é\x1c " * 7 + "é\x1cy"),
        (23, prose(9, 50) + " z" * 20_000 + " " + prose(9, 50)),
    ]
    rows = find_runs(frame(spark, texts))
    wanted = []
    for i, t in texts:
        words = [w for w in (t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        runs = [(51 - 1, 20_000, 1)] if i == 23 else [] if len(words) > 20_000 else brute(words)
        wanted.append((i, len(words), runs, " ".join(collapsed(words, runs))))
    assert found(rows) == sorted(wanted, key=repr)
    assert rows.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "runs", "collapsed"]


def test_clashing_columns_and_empty_table(spark):
    docs = frame(spark, ["x " * 9, None]).toDF("n_words", "runs", "collapsed", "start", "`p")
    with pytest.raises(Exception):
        find_runs(docs, "missing").count()
    docs = docs.withColumnRenamed("`p", "period")
    rows = find_runs(docs, "runs").orderBy("start").collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.start) for r in rows] == [
        (9, [(0, 9, 1)], "x", "s"),
        (0, [], "", "s"),
    ]
    assert find_runs(frame(spark, [])).count() == 0
