"""Stupid-backoff scores against a plain computation."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame, prose
from tripmart.llm.lm_score import score_texts


def expected(texts, order, exclude_self):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]

    def grams(ws):
        return Counter(tuple(ws[i - n : i]) for n in range(1, order + 1) for i in range(n, len(ws) + 1))

    own = [grams(ws) for ws in words]
    every = sum(own, Counter())
    total = sum(len(ws) for ws in words)
    result = []
    for ws, mine in zip(words, own, strict=True):
        def count(gram, mine=mine):
            return every[gram] - (mine[gram] if exclude_self else 0)

        others = max(1, total - (len(ws) if exclude_self else 0))
        score, backed = 0.0, 0
        for i in range(len(ws)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                gram = tuple(ws[i + 1 - n : i + 1])
                if count(gram) > 0:
                    under = others if n == 1 else count(gram[:-1])
                    score += math.log(count(gram) / under) + (longest - n) * math.log(0.4)
                    backed += n < longest
                    break
            else:
                score += longest * math.log(0.4) - math.log(others + 1)
                backed += 1
        result.append((len(ws), backed, score / len(ws) if ws else None))
    return result


@pytest.mark.parametrize(("order", "exclude_self", "block_bytes"), [(2, True, 1 << 24), (3, True, 400), (2, False, 300), (1, True, 900)])
def test_scores(spark, order, exclude_self, block_bytes):
    texts = [prose(i, 3 + i, vocabulary=15) for i in range(50)] + ["", None, "unseen", "w1x unseen w2x", prose(3, 6, 15)]
    scored = score_texts(frame(spark, texts), order=order, exclude_self=exclude_self, block_bytes=block_bytes)
    found = {r.doc_id: (r.n_words, r.n_backoff, r.log_score) for r in scored.collect()}
    for i, (n, backed, score) in enumerate(expected(texts, order, exclude_self)):
        assert found[i][:2] == (n, backed)
        assert found[i][2] == (None if score is None else pytest.approx(score))


def test_odd_rows(spark, odd_texts):
    docs = frame(spark, odd_texts).withColumn("block", F.lit("mine")).withColumn("n_words", F.lit("old"))
    scored = score_texts(docs, block_bytes=5_000)
    assert scored.columns == ["doc_id", "lang", "source", "n_chars", "block", "n_words", "n_backoff", "log_score"]
    found = sorted(((r.doc_id, r.n_words, r.n_backoff, round(r.log_score or 0, 9)) for r in scored.collect()), key=repr)
    wanted = expected([t for _, t in odd_texts], 2, True)
    rows = [(i, n, b, round(s or 0, 9)) for (i, _), (n, b, s) in zip(odd_texts, wanted, strict=True)]
    assert found == sorted(rows, key=repr)


def test_empty_table_and_order(spark):
    assert score_texts(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        score_texts(frame(spark, []), order=0)
