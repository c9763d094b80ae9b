"""License scans over a positional index of rare words.

The index holds, for each word of the license templates, the templates and positions it stands at. A word's weight is its
inverse document frequency over all scanned texts. For each template a file looks up the ``rare`` heaviest words of the template's
key phrase; each place of such a word and its posting give a relative position (where the template would begin in the file), and
the lists are intersected. An alignment counts when the template's key phrase stands at its place and enough of the
template's words do, so all looked-up words agree on it: none is lost, whatever other licenses the file holds.

Everything happens inside the row, with array functions; only the document frequencies are aggregated (one row for each
template word), so no text is shuffled. The templates are an argument, and what the plan holds of them (words, postings, weights)
grows with them alone.

Null and empty texts have no words and no labels; repeated rows get the same answer; extra columns stay.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose every place counts, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    """A license text (or its opening) and the phrase in it without which an alignment does not count."""

    label: str
    text: str
    key: str


# How license grants read.
TEMPLATES = (
    Template("mit", "Released under the MIT License", "mit license"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted"),
    Template("apache", "Licensed under the Apache License, Version 2.0", "apache license"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", "general public license"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gnu general public license"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
)


def words_in(text: str) -> list[str]:
    return re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)}))


def scan_words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def license_vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in words_in(t.text)} | {w for p, _ in PHRASES for w in words_in(p)})


def word_weights(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of each template word over all of ``docs``: one number for each word of the templates."""
    words = license_vocabulary(templates)
    own = F.array_distinct(F.filter(scan_words(F.col(text)), lambda w: w.isin(words)))
    counted = docs.select(F.explode(F.concat(own, F.array(F.lit("")))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    found = {r["w"]: r["n"] for r in counted.collect()}  # at most one row for each template word, and one for all texts
    total = found.get("", 0)
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) for w in words}


def _at(words: Column, i: Column) -> Column:
    return F.get(words, i)


def _places(words: Column, phrase: list[str]) -> Column:
    """Positions where a phrase's words stand one after the other."""
    last = F.size(words) - len(phrase)

    def stands(i):
        hit = _at(words, i) == phrase[0]
        for j, w in enumerate(phrase[1:], 1):
            hit = hit & (_at(words, i + j) == w)
        return hit

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), stands)).otherwise(F.array().cast("array<int>"))


def _alignment(words: Column, own_words: Column, template: Template, weights: dict[str, float], rare: int) -> Column:
    """The greatest share of the template's words that stand in place in an alignment with its key phrase; 0 without one."""
    own = words_in(template.text)
    key = words_in(template.key)
    key_at = next(i for i in range(len(own)) if own[i : i + len(key)] == key)
    first = {w: key_at + j for j, w in reversed(list(enumerate(key)))}  # a key word's posting
    sought = sorted(first, key=lambda w: (-weights[w], w))[:rare]

    def starts(w):  # offset-adjusted list of a word: where the template would begin
        spots = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: _at(words, i) == w)
        return F.transform(spots, lambda i: i - first[w])

    meet = starts(sought[0])  # begins on which all looked-up words agree
    for w in sought[1:]:
        meet = F.array_intersect(meet, starts(w))

    def share(s):
        keyed = F.lit(True)
        for j, w in enumerate(key):
            keyed = keyed & F.coalesce(_at(words, s + key_at + j) == w, F.lit(False))
        same = F.aggregate(F.sequence(F.lit(0), F.lit(len(own) - 1)), F.lit(0), lambda a, j: a + F.when((s + j >= 0) & F.coalesce(_at(words, s + j) == F.lit(own)[j], F.lit(False)), 1).otherwise(0))
        return F.when(keyed & (s + key_at >= 0), same / F.lit(float(len(own)))).otherwise(F.lit(0.0))

    able = F.lit(True)
    for w in first:
        able = able & F.array_contains(own_words, w)
    return F.when(able, F.coalesce(F.array_max(F.transform(meet, share)), F.lit(0.0))).otherwise(F.lit(0.0))


def scan_licenses(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES, rare: int = 6, least: float = 0.6, prefix: str = "") -> DataFrame:
    """``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score`` (``prefix`` + name).

    The score is the greatest share of a template that stands in place; a template's label counts from ``least`` on.
    """
    weights = word_weights(docs, text, templates)
    vocabulary = sorted(weights)
    words, own = F.col("__w"), F.col("__own")
    base = docs.withColumn("__w", scan_words(F.col(text)))
    # A file without all words of any key phrase can have no label: the rest is not computed for it.
    base = base.withColumn("__own", F.array_distinct(F.filter(words, lambda w: w.isin(vocabulary))))
    gates = {tuple(sorted(set(words_in(k)))) for k in [p for p, _ in PHRASES] + [t.key for t in templates]}
    able = F.lit(False)
    for gate in sorted(gates):
        every = F.lit(True)
        for w in gate:
            every = every & F.array_contains(own, w)
        able = able | every
    by_phrase = [_places(words, words_in(p)) for p, _ in PHRASES]

    scores = [_alignment(words, own, t, weights, rare) for t in templates]
    answer = F.struct(F.array(*by_phrase).alias("places"), F.array(*scores).alias("scores"))
    none = F.struct(F.array(*[F.array().cast("array<int>") for _ in PHRASES]).alias("places"), F.array(*[F.lit(0.0) for _ in templates]).alias("scores"))
    found = base.withColumn("__a", F.when(able, answer).otherwise(none))
    places, scores = F.col("__a.places"), F.col("__a.scores")
    flat = F.flatten(places)
    named = lambda flags: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*flags)))), ",")
    by_base = [F.when(F.size(places[i]) > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]
    by_template = [F.when(scores[i] >= least, F.lit(t.label)) for i, t in enumerate(templates)]
    return found.select(
        *docs.columns,
        F.size(words).cast("long").alias(f"{prefix}n_words"),
        F.size(flat).cast("long").alias(f"{prefix}n_base"),
        F.array_min(flat).cast("long").alias(f"{prefix}first_word"),
        F.array_max(flat).cast("long").alias(f"{prefix}last_word"),
        named(by_base).alias(f"{prefix}base_labels"),
        named(by_base + by_template).alias(f"{prefix}labels"),
        F.array_max(scores).alias(f"{prefix}score"),
    )
