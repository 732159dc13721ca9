"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. Its potential comes from features of the line and of the
lines before and after it; a transition table links neighbouring lines. Training
gives every line of a labelled document the document's label; then lines that
the model itself takes for clean in a bad document are relabelled, and it is
fitted again. A document's score is the mean of its lines' forward-backward
marginals, weighted by length and calibrated to the labels.

The model is fitted on a bounded sample of labelled rows (``sample_rows``, rows with the
smallest hash of their id). Everything else goes through all rows, one at a time, in
tasks of any size.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tripmart.llm.common import HashTables, buffers, mix, pieces, word_hashes

SAMPLE_ROWS = 6_000
THRESHOLD = 0.3
STEPS = 200
RATE = 0.05
PENALTY = 1e-3
CLIP = 6.0

# Byte classes that are counted per line.
CLASSES = {
    "upper": range(ord("A"), ord("Z") + 1),
    "lower": range(ord("a"), ord("z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "bang": b"!",
    "pipe": b"|",
    "symbol": b"#$%&*@^~<>{}[]=_+\\/`",
    "stop": b".,;:?\"'()-",
    "space": b" \t\r",
    "wide": range(128, 256),
}
NAMES = [*CLASSES, "length", "words", "word_length", "repeats", "doubled", "empty"]
NEIGHBOUR = ["upper", "bang", "pipe", "symbol", "repeats", "doubled"]
WIDTH = len(NAMES) + 2 * (len(NEIGHBOUR) + 1) + 1


def _lines(offsets: np.ndarray, data: np.ndarray, first: int, last: int):
    """Row, start and end of all lines; every text has one line at least."""
    low, high = offsets[first], offsets[last]
    breaks = np.flatnonzero(data[low:high] == 0x0A) + low
    owners = np.searchsorted(offsets[first : last + 1], breaks, side="right") - 1 + first
    texts = np.arange(first, last)
    rows = np.concatenate([texts, owners])
    starts = np.concatenate([offsets[first:last], breaks + 1])
    order = np.lexsort((starts, rows))
    ends = np.concatenate([breaks, offsets[first + 1 : last + 1]])
    ends = ends[np.lexsort((ends, np.concatenate([owners, texts])))]
    return rows[order], starts[order], ends


def line_features(offsets, data, first, last, tables: HashTables):
    """(row, length in bytes, features) of the lines of some texts."""
    rows, starts, ends = _lines(offsets, data, first, last)
    low = offsets[first]
    part = data[low : offsets[last]]
    length = (ends - starts).astype(np.float64)
    columns: dict[str, np.ndarray] = {}
    sums = np.zeros(len(part) + 1, np.int64)
    for name, members in CLASSES.items():
        table = np.zeros(256, np.uint8)
        table[list(members)] = 1
        np.cumsum(table[part], out=sums[1:])
        columns[name] = (sums[ends - low] - sums[starts - low]).astype(np.float64)
    words, _, word_starts, _ = word_hashes(offsets, data, first, last, tables)
    line = np.searchsorted(starts, word_starts, side="right") - 1
    # Empty texts begin where the next one does: the last line that starts there owns the word.
    count = np.bincount(line, minlength=len(starts)).astype(np.float64)
    safe = np.maximum(count, 1.0)
    pairs = line[1:] == line[:-1]
    seen = mix(mix(words[1:] + np.uint64(3) * words[:-1]) + line[1:].astype(np.uint64))[pairs]
    distinct, where = np.unique(seen, return_index=True)
    different = np.bincount(line[1:][pairs][where], minlength=len(starts))
    columns["repeats"] = 1.0 - different / np.maximum(count - 1.0, 1.0)
    columns["repeats"][count < 2] = 0.0
    content = np.zeros(len(starts), np.uint64)
    np.add.at(content, line, mix(words))
    same = mix(content + mix(rows.astype(np.uint64)))
    _, inverse, often = np.unique(same, return_inverse=True, return_counts=True)
    columns["doubled"] = ((often[inverse] > 1) & (count > 2)).astype(np.float64)
    letters = np.maximum(columns["upper"] + columns["lower"], 1.0)
    full = np.maximum(length, 1.0)
    columns["upper"] = columns["upper"] / letters
    columns["lower"] = columns["lower"] / full
    for name in ("digit", "wide", "space"):
        columns[name] = columns[name] / full
    for name in ("bang", "pipe", "symbol", "stop"):
        columns[name] = columns[name] / safe
    columns["length"] = np.log1p(length)
    columns["words"] = np.log1p(count)
    columns["word_length"] = np.minimum(length / safe, 50.0)
    columns["empty"] = (count == 0).astype(np.float64)
    return rows, length, np.column_stack([columns[n] for n in NAMES])


def with_neighbours(rows: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Append the neighbours' features, a flag where there is none, and a constant."""
    near = features[:, [NAMES.index(n) for n in NEIGHBOUR]]
    blocks = [features]
    for shift in (1, -1):
        moved = np.roll(near, shift, axis=0)
        other = np.roll(rows, shift) != rows
        edge = 0 if shift == 1 else -1
        other[edge] = True
        moved[other] = 0.0
        blocks += [moved, other[:, None].astype(np.float64)]
    return np.column_stack([*blocks, np.ones(len(rows))])


class Chains:
    """Lines of several documents, in steps: step t has line t of all that are long enough."""

    def __init__(self, rows: np.ndarray):
        begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        sizes = np.diff(np.r_[begins, len(rows)])
        order = np.argsort(-sizes, kind="stable")
        self.begins, sizes = begins[order], sizes[order]
        longest = int(sizes[0]) if len(sizes) else 0
        self.active = np.searchsorted(-sizes, -np.arange(longest), side="left")

    def marginals(self, good: np.ndarray, moves: np.ndarray):
        """P(good) per line, expected moves (2 x 2) over all chains.

        ``good`` is the log potential of good against bad; ``moves[a, b]`` that of a
        line in state b after one in state a.
        """
        n = len(good)
        ahead = np.zeros((n, 2))
        behind = np.zeros((n, 2))
        ahead[self.begins, 1] = good[self.begins]
        for t in range(1, len(self.active)):
            at = self.begins[: self.active[t]] + t
            before = ahead[at - 1]
            for state in (0, 1):
                ahead[at, state] = np.logaddexp(before[:, 0] + moves[0, state], before[:, 1] + moves[1, state])
            ahead[at, 1] += good[at]
        for t in range(len(self.active) - 1, 0, -1):
            at = self.begins[: self.active[t]] + t
            after = behind[at].copy()
            after[:, 1] += good[at]
            for state in (0, 1):
                behind[at - 1, state] = np.logaddexp(moves[state, 0] + after[:, 0], moves[state, 1] + after[:, 1])
        both = ahead + behind
        total = np.logaddexp(both[:, 0], both[:, 1])
        expected = np.zeros((2, 2))
        inner = np.ones(n, bool)
        inner[self.begins] = False
        at = np.flatnonzero(inner)
        for a in (0, 1):
            for b in (0, 1):
                score = ahead[at - 1, a] + moves[a, b] + behind[at, b] + (good[at] if b else 0.0)
                expected[a, b] = np.exp(score - total[at]).sum()
        return np.exp(both[:, 1] - total), expected


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def scaled(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.spread, -CLIP, CLIP)

    def lines(self, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
        """P(good) of every line."""
        inputs = with_neighbours(rows, self.scaled(features))
        return Chains(rows).marginals(inputs @ self.weights, self.moves)[0]

    def calibrated(self, share: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * _logit(share) + self.shift)


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _logit(p):
    p = np.clip(p, 1e-4, 1.0 - 1e-4)
    return np.log(p) - np.log1p(-p)


def weighted_share(rows: np.ndarray, length: np.ndarray, good: np.ndarray, first: int, last: int) -> np.ndarray:
    """Length-weighted mean of the lines' marginals per text."""
    weight = length + 1.0
    size = np.bincount(rows - first, weight, minlength=last - first)
    return np.bincount(rows - first, weight * good, minlength=last - first) / size


def _adam(values: list[np.ndarray], gradients, steps: int, rate: float):
    first, second = ([np.zeros_like(v) for v in values] for _ in range(2))
    for step in range(1, steps + 1):
        for v, g, m, s in zip(values, gradients(values), first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return values


def fit(rows: np.ndarray, length: np.ndarray, features: np.ndarray, labels: np.ndarray) -> QualityModel:
    """Fit the field to documents 0, 1, ... of ``rows``, whose labels (0 or 1) are ``labels``."""
    mean, spread = features.mean(0), features.std(0) + 1e-6
    model = QualityModel(mean, spread, np.zeros(WIDTH), np.zeros((2, 2)))
    inputs = with_neighbours(rows, model.scaled(features))
    chains = Chains(rows)
    inner = np.flatnonzero(np.r_[False, rows[1:] == rows[:-1]])
    state = labels[rows].astype(np.int64)
    for _ in range(2):
        given = np.zeros((2, 2))
        np.add.at(given, (state[inner - 1], state[inner]), 1.0)

        def gradients(values, given=given, state=state):
            weights, moves = values
            good, expected = chains.marginals(inputs @ weights, moves)
            scale = 1.0 / len(rows)
            return [
                inputs.T @ (good - state) * scale + PENALTY * weights,
                (expected - given) * scale + PENALTY * moves,
            ]

        model.weights, model.moves = _adam([model.weights, model.moves], gradients, STEPS, RATE)
        alone = _sigmoid(inputs @ model.weights)
        state = np.where((labels[rows] == 0) & (alone > 0.9), 1, labels[rows]).astype(np.int64)
    good = model.lines(rows, features)
    share = _logit(weighted_share(rows, length, good, 0, len(labels)))

    def gradients(values):
        slope, shift = values
        error = _sigmoid(slope * share + shift) - labels
        return [np.atleast_1d((error * share).mean() + 1e-3 * (slope[0] - 1.0)), np.atleast_1d(error.mean())]

    slope, shift = _adam([np.ones(1), np.zeros(1)], gradients, 800, 0.05)
    model.slope, model.shift = float(slope[0]), float(shift[0])
    return model


# ------------------------------------------------------------------------- Spark


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text of a batch (label, text): label, line lengths, all features in one array."""
    tables = HashTables()
    for batch in batches:
        offsets, data = buffers(batch.column(1))
        for first, last in pieces(offsets):
            rows, length, features = line_features(offsets, data, first, last, tables)
            lines = np.bincount(rows - first, minlength=last - first)
            ends = np.r_[0, np.cumsum(lines)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(length)),
                    pa.ListArray.from_arrays(pa.array(ends * len(NAMES)), pa.array(features.ravel())),
                ],
                names=["label", "length", "features"],
            )


def _score_rows(
    batches: Iterator[pa.RecordBatch], model: QualityModel | None, text_at: int, score_column: str
) -> Iterator[pa.RecordBatch]:
    tables = HashTables()
    for batch in batches:
        offsets, data = buffers(batch.column(text_at))
        score = np.full(batch.num_rows, 0.5)
        if model is not None:
            for first, last in pieces(offsets):
                rows, length, features = line_features(offsets, data, first, last, tables)
                good = model.lines(rows, features)
                score[first:last] = model.calibrated(weighted_share(rows, length, good, first, last))
        names = [*batch.schema.names, score_column]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=names)


def held_out(id_column: str) -> Column:
    """Rows that are never learned from: crc32 of the id's text is a multiple of 5."""
    crc = F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8"))
    return F.coalesce(crc % 5 == 0, F.lit(True))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel | None:
    """Fit on at most ``sample_rows`` labelled rows that are not held out.

    NULL labels and ids are left out; an id with several labels takes the smallest, so
    a document marked bad once is bad. None if the rows don't have both labels.
    """
    marked = (
        labels.filter(F.col(label_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.min(label_column).cast("int").alias("label"))
        .withColumn("_order", F.md5(F.col("_id").cast("string")))
        .orderBy("_order", "_id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text"))
    sample = marked.join(texts, "_id").orderBy("_order", F.xxhash64("text")).limit(sample_rows).select("label", "text")
    found = sample.mapInArrow(_feature_rows, "label int, length array<double>, features array<double>").toArrow()
    label = found["label"].to_numpy()
    if len(np.unique(label)) < 2:
        return None
    lists = found["length"].combine_chunks()
    rows = np.repeat(np.arange(len(label)), np.diff(lists.offsets.to_numpy()))
    features = found["features"].combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES))
    return fit(rows, lists.flatten().to_numpy(), features, label.astype(np.float64))


def score_documents(
    docs: DataFrame, model: QualityModel | None, text_column: str = "text", score_column: str = "score"
) -> DataFrame:
    """All rows with the probability of good quality.

    NULL and empty texts are scored as one empty line. Without a model every score is
    0.5. Repeated rows get equal scores. An empty table gives an empty result. A column
    of ``docs`` named like the score is replaced; all others stay.
    """
    docs = docs.drop(score_column)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    scorer = functools.partial(
        _score_rows, model=model, text_at=docs.columns.index(text_column), score_column=score_column
    )
    return docs.mapInArrow(scorer, f"{fields}, `{score_column}` double")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents whose score reaches the threshold, with the columns of ``docs``."""
    scored = score_documents(docs, train(docs, labels, **options), score_column="_score")
    return scored.filter(F.col("_score") >= threshold).select(*docs.columns)
