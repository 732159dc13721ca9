"""Periodic runs of words: maximal stretches that repeat a period at least four times.

A run of period q holds an aligned block of 2^k words, the smallest power of two that is q
or more, and the block's next or previous occurrence is exactly q words away. So the
repeated blocks of each document are sorted by prefix doubling, which gives a suffix array
of the repeated part of the text and, for each block, the range of suffixes that begin with it.
A wavelet matrix over the array answers, for all blocks at once, which occurrence
follows and which precedes the block. Occurrences in a neighbouring window of the
block's length form a progression whose difference is the only candidate period;
stretches of that period around the block are then measured on the words themselves.

Documents are independent: rows stay in their task, and a task holds about a megabyte of
text at a time, or one document where that is longer. No hashes are compared, words have
exact numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tripmart.llm.common import buffers, pieces

LEAST_WORDS = 6
REPEATS = 4

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_BLANK = pa.scalar(" ", pa.large_string())
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


class WaveletMatrix:
    """Order statistics of ranges of a sequence of the numbers 0 to n - 1, many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        for bit in reversed(range(max(1, int(len(values) - 1).bit_length()))):
            ones = (values >> bit) & 1 == 1
            zeros_before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(~ones, out=zeros_before[1:])
            self.levels.append((bit, zeros_before, int(zeros_before[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    def smaller(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the places ``low`` to ``high`` hold less than ``value``."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros_before, zeros in self.levels:
            one = (value >> bit) & 1 == 1
            at_low, at_high = zeros_before[low], zeros_before[high]
            count += np.where(one, at_high - at_low, 0)
            low = np.where(one, zeros + low - at_low, at_low)
            high = np.where(one, zeros + high - at_high, at_high)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The ``n``-th smallest value (from 0) of the places ``low`` to ``high``."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros_before, zeros in self.levels:
            at_low, at_high = zeros_before[low], zeros_before[high]
            here = at_high - at_low
            one = n >= here
            value |= one.astype(np.int64) << bit
            n = np.where(one, n - here, n)
            low = np.where(one, zeros + low - at_low, at_low)
            high = np.where(one, zeros + high - at_high, at_high)
        return value

    def neighbours(self, low: np.ndarray, high: np.ndarray, value: np.ndarray):
        """The largest smaller and the smallest larger value of each range that holds ``value``; -1 where none."""
        rank = self.smaller(low, high, value)
        before = np.full(len(low), -1, np.int64)
        after = before.copy()
        some = np.flatnonzero(rank > 0)
        before[some] = self.nth(low[some], high[some], rank[some] - 1)
        some = np.flatnonzero(rank + 1 < high - low)
        after[some] = self.nth(low[some], high[some], rank[some] + 1)
        return before, after


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the keys; per ordered key the place where its group begins, and the group's size."""
    order = np.argsort(key)
    if not len(order):
        return order, order, order
    ordered = key[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    sizes = np.diff(np.r_[begins, len(ordered)])
    return order, np.repeat(begins, sizes), np.repeat(sizes, sizes)


def _blocks(words: np.ndarray, borders: np.ndarray):
    """The suffix array of all places whose first two words recur in their document, and the
    repeated aligned blocks: their place, length, and range of the array."""
    sizes = np.diff(borders)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    end = borders[1:][owner]
    size = sizes[owner]
    order, name, count = _groups(owner * (int(words.max(initial=0)) + 1) + words)
    names = np.full(len(words) + 1, -1, np.int64)
    repeated = count > 1
    names[order[repeated]] = name[repeated]
    at = np.arange(len(words))
    at = at[(names[:-1] >= 0) & (names[1:] >= 0) & (at + 2 <= end) & (size >= LEAST_WORDS)]
    order, name, count = _groups(names[at] * (len(words) + 1) + names[at + 1])
    kept = count > 1
    suffixes = at[order[kept]]
    slots = np.arange(len(suffixes))
    _, name, count = _groups(np.cumsum(np.r_[0, np.diff(name[kept]) != 0])) if len(slots) else (slots, slots, slots)
    found = []
    length = 2
    while len(slots):
        at = suffixes[slots]
        aligned = (at - borders[owner[at]]) % length == 0
        found.append((at[aligned], np.full(aligned.sum(), length), name[aligned], (name + count)[aligned]))
        names[:] = -1
        names[at] = name
        following = names[np.minimum(at + length, len(words))]
        # The next length finds periods above this one, which must fit several times.
        going = (following >= 0) & (at + 2 * length <= end[at]) & (REPEATS * (length + 1) <= size[at])
        # Within its group a suffix that ends here or goes on to something unique comes first.
        key = name * (len(suffixes) + 2) + np.where(going, following + 1, 0)
        order, begin, count = _groups(key)
        suffixes[slots] = at[order]
        kept = going[order] & (count > 1)
        name, count, slots = slots[begin][kept], count[kept], slots[kept]
        length *= 2
    if not found:
        return suffixes, *(np.empty(0, np.int64) for _ in range(4))
    return suffixes, *(np.concatenate(column) for column in zip(*found, strict=True))


def _candidates(words: np.ndarray, borders: np.ndarray):
    """Places and periods of squares, one for every run at least."""
    suffixes, at, length, low, high = _blocks(words, borders)
    if not len(at):
        return at, at
    places = np.sort(suffixes)
    matrix = WaveletMatrix(np.searchsorted(places, suffixes))
    before, after = matrix.neighbours(low, high, np.searchsorted(places, at))
    back = np.where(before >= 0, at - places[before], length + 1)
    ahead = np.where(after >= 0, places[after] - at, length + 1)
    near, close = back <= length, ahead <= length
    return np.r_[(at - back)[near], at[close]], np.r_[back[near], ahead[close]]


def runs_of(words: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Runs of several documents: rows of (document, start, length, period), sorted.

    ``words`` are the numbers of the words of all documents, ``borders`` where each begins and ends.
    """
    at, period = _candidates(words, borders)
    if not len(at):
        return np.empty((0, 4), np.int64)
    owner = np.searchsorted(borders, at, side="right") - 1
    order = np.lexsort((at, period, owner))
    at, period, owner = at[order], period[order], owner[order]
    begins = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (period[1:] != period[:-1])])
    found = []
    for low, high in zip(begins, np.r_[begins[1:], len(at)], strict=True):
        document, q = int(owner[low]), int(period[low])
        first, last = borders[document], borders[document + 1]
        same = words[first : last - q] == words[first + q : last]
        edges = np.flatnonzero(np.diff(np.r_[False, same, False].view(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        # A long stretch that no candidate lies in has a smaller period.
        own = np.zeros(len(starts), bool)
        own[np.searchsorted(starts, at[low:high] - first, side="right") - 1] = True
        length = stops - starts + q
        for k in np.flatnonzero(own & (length >= max(LEAST_WORDS, REPEATS * q))):
            found.append((document, int(starts[k]), int(length[k]), q))
    return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


def _split(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Borders of the texts in the list of all their words, and that list."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    real = pc.greater(pc.binary_length(words), 0)
    counts = np.bincount(rows[real.to_numpy(zero_copy_only=False)], minlength=len(lists))
    return np.r_[0, np.cumsum(counts)], words.filter(real)


def _piece(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Number of words, runs, and text without repeats, of each text."""
    borders, words = _split(texts)
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = runs_of(numbers, borders)
    change = np.zeros(len(words) + 1, np.int64)
    begin = borders[runs[:, 0]] + runs[:, 1]
    np.add.at(change, begin + runs[:, 3], 1)
    np.add.at(change, begin + runs[:, 2], -1)
    kept = np.cumsum(change[:-1]) == 0
    left = np.r_[0, np.cumsum(kept)][borders]
    lists = pa.LargeListArray.from_arrays(pa.array(left), words.filter(pa.array(kept)))
    ends = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(_RUN))
    return pa.array(np.diff(borders)), pa.ListArray.from_arrays(pa.array(ends), rows), pc.binary_join(lists, _BLANK)


def find_runs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All rows without their text, with ``n_words``, ``runs`` and ``collapsed``.

    Words are separated by spaces and the bytes 9 to 13. ``runs`` are all maximal stretches of
    six words or more whose smallest period fits four times or more, as (start, length,
    period) by start, then period; two runs may overlap. ``collapsed`` is the text
    without the words that some run holds after its first period, joined by one space.

    NULL and empty texts have no words, no runs and an empty text. Texts of any length are
    worked on whole, in memory of about 100 bytes a word. Ties (several runs at one start)
    are ordered by period; repeated rows give equal results each. An empty table gives an
    empty result. Columns of ``docs`` named like a result are replaced, all others stay.
    """
    added = ("n_words", "runs", "collapsed")
    rest = docs.drop(*[c for c in added if c != text_column])
    kept = [c for c in rest.columns if c != text_column]
    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)
    text_at = rest.columns.index(text_column)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.large_string()).fill_null("")
            others = batch.select([i for i in range(batch.num_columns) if i != text_at])
            for first, last in pieces(buffers(texts)[0]):
                part = others.slice(first, last - first)
                results = _piece(texts.slice(first, last - first))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, results[0], results[1], results[2].cast(pa.string())], names=[*part.schema.names, *added]
                )

    return rest.mapInArrow(rows, f"{fields}n_words bigint, runs {RUNS}, collapsed string")
