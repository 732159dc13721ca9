"""Licence scan over a positional rare-token index.

The index holds every template's words with their positions. How rare a word is
comes from the corpus: document frequencies of all template words are counted
over all texts. In a document only each template's rarest words are looked up, as many as its
share of words in place asks for, so that no place is missed.
An occurrence at position i of a word that stands at position p of a template
proposes the start i - p; proposals of several rare words are intersected by
this relative position. A start counts when enough of the template's words stand
at their places and every mandatory phrase is there word by word.

All of it is array functions on one row per document; only the word frequencies
are shuffled, at most one row per template word and task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

# Lower case for A-Z only, and the characters between words.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence text: its label, words, mandatory phrases and the share of words to be in place."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    share: float = 1.0
    base: bool = False
    words: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "words", tuple(self.text.split()))
        for phrase in self.phrases:
            if f" {phrase} " not in f" {self.text} ":
                raise ValueError(f"'{phrase}' does not stand in the template of {self.label}")


# Phrases and labels of the contract.
BASE_TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)

# Public licence notices, lower case, without punctuation.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",), 0.75),
    Template("mit", "released under the mit license", ("mit license",), 0.6),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
        ("permission is hereby granted", "associated documentation files"),
        0.8,
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source and binary forms",),
        0.8,
    ),
    Template(
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
        0.75,
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
        0.8,
    ),
    Template("cc-by-nc", "licensed under cc by nc", ("cc by nc",), 0.75),
    Template("cc-by-sa", "licensed under cc by sa", ("cc by sa",), 0.75),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
        0.8,
    ),
)
TEMPLATES = BASE_TEMPLATES + NOTICES

# Rare words looked up per template at least, and how many must agree on a start.
RARE_WORDS = 3
AGREEING = 2


def license_words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lower, BETWEEN), "")


def word_weights(words: DataFrame, templates) -> dict[str, float]:
    """Inverse document frequencies of the template words over all documents.

    ``words`` has an array column ``_words``. The result has one entry per
    template word, whatever the size of the corpus.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    known = F.array_distinct(F.filter("_words", lambda w: w.isin(vocabulary)))
    marked = words.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("word"))
    seen = {r["word"]: r["n"] for r in marked.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = seen.get("", 0)
    return {w: math.log((rows + 1) / (seen.get(w, 0) + 1)) + 1.0 for w in vocabulary}


def rare_positions(template: Template, weights: dict[str, float], rare: int, agreeing: int) -> list[int]:
    """Positions of the template's words of highest weight, rarest first: ``rare`` of them, or as many
    as make sure that no place is missed.

    A place whose share is high enough lacks words of a bounded weight. Once those looked up weigh more than that
    without their ``agreeing - 1`` heaviest, ``agreeing`` of them stand in every such place.
    """
    order = sorted(range(len(template.words)), key=lambda p: (-weights[template.words[p]], p))
    if template.share >= 1:
        return order[:1]
    heavy = [weights[template.words[p]] for p in order]
    lacking = (1.0 - template.share) * sum(heavy)
    count = min(rare, len(order))
    while count < len(order) and sum(heavy[agreeing - 1 : count]) <= lacking + 1e-9:
        count += 1
    return order[:count]


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _starts(template: Template, weights: dict[str, float], rare: int, agreeing: int) -> Column:
    """Array of struct(start, share) of a template's places in ``_words``, by ``_hits``."""
    n = len(template.words)
    places = rare_positions(template, weights, rare, agreeing)

    def proposals(position: int) -> Column:
        same = F.filter("_hits", lambda h: h["word"] == F.lit(template.words[position]))
        return F.transform(same, lambda h: h["at"] - F.lit(position))

    each = [proposals(p) for p in places]
    every = F.array_distinct(F.concat(*each))
    need = min(agreeing, len(places))
    if need > 1:
        def votes(start):
            return sum((F.array_contains(e, start).cast("int") for e in each[1:]), F.array_contains(each[0], start).cast("int"))

        every = F.filter(every, lambda s: votes(s) >= need)
    if template.share >= 1:
        text = _strings(template.words)
        exact = F.filter(every, lambda s: (s >= 0) & (F.slice("_words", F.greatest(s, F.lit(0)) + 1, n) == text))
        return F.transform(exact, lambda s: F.struct(s.alias("start"), F.lit(1.0).alias("share")))
    total = sum(weights[w] for w in template.words)

    def share(start):
        found = F.lit(0.0)
        for p, word in enumerate(template.words):
            there = F.try_element_at(F.col("_words"), F.greatest(start + p, F.lit(-1)) + 1) == F.lit(word)
            found = found + F.when((start + p >= 0) & there, F.lit(weights[word])).otherwise(F.lit(0.0))
        return found / F.lit(total)

    def mandatory(start):
        held = F.lit(True)
        for phrase in template.phrases:
            text = phrase.split()
            offset = next(i for i in range(n) if list(template.words[i : i + len(text)]) == text)
            at = start + offset
            held = held & (at >= 0) & (F.slice("_words", F.greatest(at, F.lit(0)) + 1, len(text)) == _strings(text))
        return held

    held = F.filter(every, mandatory)
    shares = F.transform(held, lambda s: F.struct(s.alias("start"), share(s).alias("share")))
    return F.filter(shares, lambda x: x["share"] >= F.lit(template.share))


def _places(template: Template, starts: Column) -> Column:
    def place(x):
        return F.struct(
            F.lit(template.label).alias("label"),
            F.lit(template.base).alias("base"),
            x["start"].alias("start"),
            (x["start"] + len(template.words)).alias("end"),
            x["share"].alias("share"),
        )

    return F.transform(starts, place)


def scan_licenses(
    docs: DataFrame,
    text_column: str = "text",
    templates=TEMPLATES,
    rare: int = RARE_WORDS,
    agreeing: int = AGREEING,
) -> DataFrame:
    """All rows with ``n_words`` and ``places``: array of (label, base, start, end, share).

    ``start`` and ``end`` count words from 0; places are in the order of templates,
    then of occurrence. Every place is found whose words in place weigh at least the template's share
    and that holds its mandatory phrases; it may begin before the text or end after it. A NULL or empty
    text has no words and no places; a very long one is one array of words in its task. Repeated rows
    are scanned one by one, ties (several templates at one place) are all listed. An empty table gives an empty result. Columns of
    ``docs`` named like a result are replaced.
    """
    docs = docs.drop("n_words", "places")
    worded = docs.withColumn("_words", license_words(F.col(text_column)))
    weights = word_weights(worded.select("_words"), templates)
    looked_up = sorted({t.words[p] for t in templates for p in rare_positions(t, weights, rare, agreeing)})
    at = F.transform("_words", lambda w, i: F.when(w.isin(looked_up), F.struct(w.alias("word"), i.alias("at"))))
    hit = worded.withColumn("_hits", F.filter(at, lambda h: h.isNotNull()))
    found = [_places(template, _starts(template, weights, rare, agreeing)) for template in templates]
    none = F.filter(F.concat(*found), lambda x: F.lit(False))
    places = F.when(F.size("_hits") > 0, F.concat(*found)).otherwise(none)
    return hit.select(*docs.columns, F.size("_words").cast("long").alias("n_words"), places.alias("places"))


def license_digest(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The columns of the contract from ``scan_licenses``."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("long"))

    def joined(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return scanned.select(
        id_column,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)), 6).alias("score"),
    )
