"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text more.

One dictionary is trained on ordinary text. The other one holds the same ordinary text
and, in front of it, text trained on what marks toxic documents: words that stand in many different
contexts of toxic documents and hardly ever elsewhere. (A word that only copies of one
document share has one context.) A document's words are cut into windows of sixteen,
and each window is compressed with both. Since the ordinary part is common, the lengths
differ where toxic text is met, also where a word only shares a long part with one learned.
How many windows gain how many bytes is weighed by a logistic function fitted to the labels.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` of each label and
``SAMPLE_BYTES`` of their text, in the order of a hash of their id). Everything else goes through
all rows and whole texts.
"""

from __future__ import annotations

import functools
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripmart.llm.common import mix

SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 16 << 20
THRESHOLD = 0.5
WINDOW_WORDS = 16
CHUNK_CHARS = 1 << 20  # about so much of a text is in words at a time
COMPRESSION_LEVEL = 7
ORDINARY_BYTES = 64 << 10
TOXIC_BYTES = 8 << 10
ORDINARY_SAMPLES = 60_000
SEGMENT = 24  # bytes of text that dictionary training weighs as one

LEAST_CONTEXTS = 6
LOG_ODDS = 2.0
GAINS = (1, 2, 3, 4, 5, 6, 8)
LOSSES = (2, 3, 4)

_BREAK = re.compile(r"\s")


# ------------------------------------------------------------------------- windows


def _chunks(text: str) -> Iterator[list[str]]:
    """The words of a text in lower case, a bounded number of characters at a time."""
    begin = 0
    while begin < len(text):
        cut = _BREAK.search(text, begin + CHUNK_CHARS) if begin + CHUNK_CHARS < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[begin:end].lower().split()
        begin = end


def windows(text: str) -> Iterator[bytes]:
    """Runs of sixteen words, the last ones of a chunk may be fewer."""
    for words in _chunks(text):
        for k in range(0, len(words), WINDOW_WORDS):
            yield f" {' '.join(words[k : k + WINDOW_WORDS])} ".encode()


class Lengths:
    """Compressed lengths under one dictionary."""

    def __init__(self, dictionary: bytes):
        settings = zstandard.ZstdCompressionParameters.from_level(
            COMPRESSION_LEVEL,
            source_size=128,
            dict_size=len(dictionary),
            min_match=4,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=settings)
        self._compressor = zstandard.ZstdCompressor(dict_data=content, compression_params=settings)

    def of(self, parts: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, parts), np.uint64, len(parts))
        begins = np.cumsum(sizes) - sizes
        segments = zstandard.BufferWithSegments(b"".join(parts), np.column_stack([begins, sizes]).tobytes())
        shortened = self._compressor.multi_compress_to_buffer(segments)
        return np.fromiter((len(shortened[i]) for i in range(len(parts))), np.int64, len(parts))


def _features(gains: np.ndarray) -> np.ndarray:
    """What the model weighs of the bytes that a document's windows gain."""
    count = max(1, len(gains))
    found = [np.log1p(len(gains)), gains.max(initial=-20) if len(gains) else 0.0, gains.sum() / count]
    for members in [*(gains >= g for g in GAINS), *(gains <= -g for g in LOSSES)]:
        found += [np.log1p(members.sum()), members.sum() / count]
    return np.array(found, np.float64)


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def scores(self, texts: Iterator[str]) -> Iterator[float]:
        """P(toxic) of each text."""
        plain, marked = Lengths(self.ordinary), Lengths(self.toxic + self.ordinary)
        for text in texts:
            yield self._logistic(_features(_gains(text, plain, marked)))

    def _logistic(self, features: np.ndarray) -> float:
        inputs = np.append(np.clip((features - self.mean) / self.spread, -8.0, 8.0), 1.0)
        return float(0.5 * (1.0 + np.tanh(0.5 * (inputs @ self.weights))))


def _gains(text: str, plain: Lengths, marked: Lengths) -> np.ndarray:
    """Bytes by which the toxic dictionary shortens each window more than the ordinary one."""
    found, parts, size = [np.empty(0, np.int64)], [], 0
    for part in windows(text):
        parts.append(part)
        size += len(part)
        if size > CHUNK_CHARS:
            found.append(plain.of(parts) - marked.of(parts))
            parts, size = [], 0
    if parts:
        found.append(plain.of(parts) - marked.of(parts))
    return np.concatenate(found)


# ------------------------------------------------------------------------- training


def _words(texts: list[str]) -> Iterator[str]:
    """The words of some texts; each text begins with an empty one."""
    for text in texts:
        yield ""
        for words in _chunks(text):
            yield from words


def _contexts(texts: list[str], numbers: dict[str, int]) -> np.ndarray:
    """In how many different pairs of neighbours each word stands; gives new words their numbers."""
    bare = (w.strip(string.punctuation) for w in _words(texts))
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in bare), np.uint64)
    around = mix(mix(mix(np.r_[np.uint64(0), at[:-1]]) + at) + np.r_[at[1:], np.uint64(0)])
    first = np.unique(around, return_index=True)[1]
    return np.bincount(at[first].astype(np.int64), minlength=len(numbers))


def marking_words(toxic: list[str], ordinary: list[str], least: int = LEAST_CONTEXTS, log_odds: float = LOG_ODDS) -> set[str]:
    """Words whose contexts are mostly those of toxic documents."""
    numbers: dict[str, int] = {"": 0}
    elsewhere = _contexts(ordinary, numbers)
    here = _contexts(toxic, numbers)
    elsewhere = np.r_[elsewhere, np.zeros(len(here) - len(elsewhere), np.int64)]
    odds = np.log((here + 0.5) / (here.sum() + 1.0)) - np.log((elsewhere + 0.5) / (elsewhere.sum() + 1.0))
    chosen = (here >= least) & (odds >= log_odds)
    chosen[0] = False
    return {w for w, n in numbers.items() if chosen[n]}


def _content(samples: list[bytes], size: int, segment: int) -> bytes:
    """The text that dictionary training selects; all of it where it is too little to train on."""
    joined = b"".join(samples)
    if len(joined) <= size or len(samples) < 10:
        return joined[-size:]
    try:
        trained = zstandard.train_dictionary(size, samples, k=segment, d=6)
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]
    # Only the text is used: windows are too short for the statistics in front of it to differ.
    return trained.as_bytes()[-size:]


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray) -> ToxicityModel:
    """Train the dictionaries and the weighing on some labelled texts, each of which counts ``weights`` times."""
    toxic = [t for t, label in zip(texts, labels, strict=True) if label == 1]
    ordinary = [t for t, label in zip(texts, labels, strict=True) if label != 1]
    marking = set()
    for least in (LEAST_CONTEXTS, 3, 2, 1):
        marking = marking or marking_words(toxic, ordinary, least)
    marked = [f" {w} ".encode() for w in _words(toxic) if w.strip(string.punctuation) in marking]
    random = np.random.default_rng(11)
    plain = [p for t in ordinary for p in windows(t)]
    plain = [plain[i] for i in random.permutation(len(plain))[:ORDINARY_SAMPLES]]
    marked = [marked[i] for i in random.permutation(len(marked))]
    model = ToxicityModel(
        _content(plain, ORDINARY_BYTES, 200), _content(marked, TOXIC_BYTES, SEGMENT), np.zeros(0), np.zeros(0), np.zeros(0)
    )
    lengths = Lengths(model.ordinary), Lengths(model.toxic + model.ordinary)
    features = np.array([_features(_gains(t, *lengths)) for t in texts])
    model.mean, model.spread = features.mean(0), features.std(0) + 1e-6
    inputs = np.column_stack([np.clip((features - model.mean) / model.spread, -8.0, 8.0), np.ones(len(features))])
    weighing = np.zeros(inputs.shape[1])
    for _ in range(60):
        p = 0.5 * (1.0 + np.tanh(0.5 * (inputs @ weighing)))
        bend = (inputs * (weights * p * (1.0 - p))[:, None]).T @ inputs + np.eye(len(weighing))
        step = np.linalg.solve(bend, inputs.T @ (weights * (labels - p)) - weighing)
        weighing = weighing + step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = weighing
    return model


# ------------------------------------------------------------------------- Spark


def held_out(id_column: str) -> Column:
    """Rows that are never learned from: crc32 of the id's text is a multiple of 5."""
    crc = F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8"))
    return F.coalesce(crc % 5 == 0, F.lit(True))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> ToxicityModel | None:
    """Fit on at most ``sample_rows`` rows and ``sample_bytes`` of each label, none of them held out.

    NULL labels and ids are left out; an id with several labels takes the largest, so a
    document marked toxic once is toxic. None if the rows don't have both labels.
    """
    marked = (
        labels.filter(F.col(label_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id"))
        .agg((F.max(label_column) > 0).cast("int").alias("label"))
        .withColumn("_order", F.md5(F.col("_id").cast("string")))
    )
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if set(counts) != {0, 1}:
        return None
    texts = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ahead = Window.partitionBy("label").orderBy("_order", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found: dict[int, list[str]] = {}
    for label in (0, 1):
        ids = marked.filter(F.col("label") == label).orderBy("_order", "_id").limit(sample_rows)
        rows = ids.join(texts, "_id").withColumn("_tie", F.xxhash64("text")).orderBy("_order", "_tie").limit(sample_rows)
        within = rows.withColumn("_sum", F.sum(F.octet_length("text")).over(ahead)).filter(F.col("_sum") <= sample_bytes)
        found[label] = within.select("text").toArrow()["text"].to_pylist()
    if not found[0] or not found[1]:
        return None
    target = np.r_[np.zeros(len(found[0])), np.ones(len(found[1]))]
    weight = np.r_[*(np.full(len(found[k]), counts[k] / len(found[k])) for k in (0, 1))]
    return fit(found[0] + found[1], target, weight * len(target) / weight.sum())


def _score_rows(
    batches: Iterator[pa.RecordBatch], model: ToxicityModel | None, text_at: int, score_column: str, keep_text: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if model is None:
            score = np.zeros(batch.num_rows)
        else:
            texts = (text.as_py() or "" for text in batch.column(text_at))
            score = np.fromiter(model.scores(texts), np.float64, batch.num_rows)
        kept = batch.select([i for i in range(batch.num_columns) if keep_text or i != text_at])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(score)], names=[*kept.schema.names, score_column])


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel | None,
    text_column: str = "text",
    score_column: str = "score",
    keep_text: bool = True,
) -> DataFrame:
    """All rows with the probability that their text is toxic; without ``keep_text`` the text stays behind.

    NULL and empty texts have no windows and take the score of a text in which nothing was
    found. Texts of any length are read whole, a megabyte at a time. Without a model every
    score is 0. Repeated rows and equal texts (ties) get equal scores. An empty table gives
    an empty result. A column of ``docs`` named like the score is replaced; all others stay.
    """
    docs = docs.drop(score_column)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_column]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    at = docs.columns.index(text_column)
    scorer = functools.partial(_score_rows, model=model, text_at=at, score_column=score_column, keep_text=keep_text)
    return docs.mapInArrow(scorer, f"{fields}`{score_column}` double")
