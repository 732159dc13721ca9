import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))


def frame(spark, texts, sources=None):
    """Documents 0, 1, ... with these texts; a pair gives the id as well."""
    rows = []
    for i, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (i, text)
        source = sources[i % len(sources)] if sources else "s"
        rows.append((doc_id, text, "en", source, len(text or "")))
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def odd_texts():
    """NULL and empty texts, missing ids, ties, repeated rows, one very long text."""
    long = prose(5, 30_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (None, None), (5, "one"), (6, prose(1, 40)),
        (6, prose(1, 40)), (6, prose(2, 30)), (7, prose(1, 40)), (8, long), (9, long), (None, prose(1, 40)),
        (10, " café 世界\x0b" + prose(3, 20)), (11, "x" * 50_000),
    ]
