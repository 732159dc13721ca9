"""Word hashes: equal words wherever they stand, different ones of any form apart."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import frame
from tripmart.llm.common import LONG_WORD, HashTables, buffers, word_hashes
from tripmart.llm.lm_score import score_texts
from tripmart.llm.ngram_join import similarity_classes
from tripmart.llm.substrings import remove_repeats


def hashes(texts):
    offsets, data = buffers(pa.array(texts))
    found, rows, starts, ends = word_hashes(offsets, data, 0, len(texts), HashTables())
    return found, rows, [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)]


def thue_morse(letters, size):
    """Two words that agree in every sum of powers modulo 2^64 once they are long enough."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(size))


def test_hash_depends_on_the_word_alone():
    rng = random.Random(4)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    words += ["x" * n for n in (1, 7, 8, 9, 15, 16, 17, LONG_WORD - 1, LONG_WORD, LONG_WORD + 1, 50_000)]
    texts = [" ".join(rng.sample(words, 40)) for _ in range(50)] + ["", " \t", None] + words
    found, rows, read = hashes(texts)
    assert [w.decode() for w in read] == [w for t in texts for w in (t or "").split()]
    assert rows.tolist() == [i for i, t in enumerate(texts) for _ in (t or "").split()]
    known = {}
    for word, h in zip(read, found.tolist(), strict=True):
        assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


def test_words_of_special_forms_differ():
    pairs = [w for n in (2**k for k in range(1, 15)) for w in (thue_morse("ab", n), thue_morse("ba", n))]
    pairs += ["a\0b", "a\0c", "a\0", "a", "\0", "\0\0"]
    assert len(np.unique(hashes(pairs)[0])) == len(set(pairs))


@pytest.mark.parametrize("size", [1024, 8192])
def test_operators_tell_such_words_apart(spark, size):
    one, two = thue_morse("ab", size), thue_morse("ba", size)
    twelve = "k0 k1 k2 k3 k4 k5 k6 k7 k8 k9 k10 k11"
    docs = frame(spark, [f"{twelve} {one}", f"{twelve} {two}", f"{twelve} {one}"])
    removed = {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()}
    assert removed == {0: 0, 1: 0, 2: 13}
    texts = {r.doc_id: r.text_id for r in similarity_classes(docs).collect()}
    assert texts[0] == texts[2] != texts[1]
    # The last word of document 1 stands nowhere else.
    backed = {r.doc_id: r.n_backoff for r in score_texts(docs).collect()}
    assert backed == {0: 0, 1: 1, 2: 0}
