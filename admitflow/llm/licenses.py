"""Licence notices by a positional index of rare words.

Every template is a run of words. Its postings say at which place each of its words stands. Of the words of a template the
one that the fewest documents hold is looked up in a file; each place where the file has it, less the place in the
template, is where the template could begin there. The other words are then intersected at the same relative places, and
the template's mandatory key phrase has to stand where it belongs, in full.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[int, int]  # the mandatory phrase: first word and the one after the last
    share: float  # of its words that must stand at their places
    base: bool = False


def _template(label: str, text: str, key: str, share: float = 0.8) -> Template:
    words, phrase = tuple(text.split()), tuple(key.split())
    at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
    return Template(label, words, (at, at + len(phrase)), share)


def _phrase(label: str, text: str) -> Template:
    words = tuple(text.split())
    return Template(label, words, (0, len(words)), 1.0, True)


# The phrases and their labels.
PHRASES = [
    _phrase("mit", "mit license"),
    _phrase("apache", "apache license"),
    _phrase("gpl", "general public license"),
]
# Opening words of the licences' own texts.
NOTICES = [
    _template("spdx", "spdx license identifier", "spdx license identifier"),
    _template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files",
        "any person obtaining a copy",
    ),
    _template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
        " the license",
        "you may not use this file except in compliance",
    ),
    _template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license",
        "redistribute it and or modify it",
    ),
    _template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met",
        "source and binary forms",
    ),
    _template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license",
        "mozilla public license",
    ),
    _template("lgpl", "gnu lesser general public license", "lesser general public license"),
    _template("agpl", "gnu affero general public license", "affero general public license"),
]

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HIT = "array<struct<at:int,word:string>>"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case: runs of a-z, 0-9 and whatever is not ASCII.

    Lower-casing would turn two other letters into ASCII ones; they are put out of its way.
    """
    safe = F.replace(F.replace(text, F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı"))
    return F.array_remove(F.split(F.lower(safe), _BREAKS, -1), "")


def _rarest(docs: DataFrame, templates: list[Template]) -> dict[str, float]:
    """Share of all documents that hold each of the templates' words: at most one row per word."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.col("text").cast("string")).select(F.explode(held).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in rows.collect()}
    return {w: found.get(w, 0) for w in vocabulary}


def _lookup(template: Template, frequency: dict[str, float]) -> int:
    """Place of the template's rarest word; in the key phrase, as that has to be there in full."""
    first, end = template.key
    return min(range(first, end), key=lambda i: (frequency[template.words[i]], i))


def _share(template: Template, start: Column) -> Column:
    """Share of the template's words at their places, or 0 where the key phrase is not complete."""
    words = F.col("words")
    here = lambda i: F.get(words, start + i).eqNullSafe(F.lit(template.words[i]))
    complete = F.lit(True)
    for i in range(*template.key):
        complete = complete & here(i)
    rest = [i for i in range(len(template.words)) if not template.key[0] <= i < template.key[1]]
    matched = F.lit(template.key[1] - template.key[0])
    for i in rest:
        matched = matched + here(i).cast("int")
    return F.when(complete, matched / F.lit(float(len(template.words)))).otherwise(F.lit(0.0))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices) of every row.

    ``notices`` lists label and first word of each place a template matched; ``score`` is the largest matched share, 1
    where a phrase stands. A null text has no words, no labels and score 0. Whole texts are read, repeated rows get equal
    results, ids may be null, other columns are not read, and an empty table gives none. Where words are equally rare the
    first in the template is looked up.
    """
    templates = [*PHRASES, *NOTICES]
    frequency = _rarest(docs, templates)
    lookups = {t: _lookup(t, frequency) for t in templates}
    rare = sorted({t.words[i] for t, i in lookups.items()})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", words_of(text).alias("words"))
    # The file's positional index, of the looked-up words only.
    indexed = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda h: h["word"].isin(rare)
    )
    some = F.arrays_overlap("words", F.array(*map(F.lit, rare)))
    rows = rows.withColumn("hits", F.when(some, indexed).otherwise(F.array().cast(_HIT)))

    def places(template: Template) -> Column:
        place = lookups[template]
        word = template.words[place]
        starts = F.transform(
            F.filter("hits", lambda h: (h["word"] == word) & (h["at"] >= place)), lambda h: h["at"] - place
        )
        scored = F.transform(
            starts,
            lambda s: F.struct(
                s.alias("at"), F.lit(template.label).alias("label"), _share(template, s).alias("share")
            ),
        )
        return F.filter(scored, lambda m: m["share"] >= template.share)

    none = F.array().cast("array<struct<at:int,label:string,share:double>>")
    matched = lambda ts: F.when(F.size("hits") > 0, F.concat(*map(places, ts))).otherwise(none)
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        matched(PHRASES).alias("base"),
        matched(NOTICES).alias("own"),
    )
    labels = lambda *of: F.array_join(
        F.array_sort(F.array_distinct(F.transform(F.concat(*of), lambda m: m["label"]))), ","
    )
    starts = F.transform("base", lambda m: m["at"])
    both = F.concat("base", "own")
    shown = lambda m: F.concat_ws(":", m["label"], m["at"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("base", "own").alias("labels"),
        F.coalesce(F.array_max(F.transform(both, lambda m: m["share"])), F.lit(0.0)).alias("score"),
        F.array_join(F.transform(F.array_sort(both), shown), ",").alias("notices"),
    )
