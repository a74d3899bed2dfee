"""Licence scans with a positional index of rare words, in DataFrame functions only.

Templates are licence notices with mandatory key phrases; the three plain names (``mit license`` and
so on) are templates that consist of their key phrase. The index has, per template, the two words of
its key phrases that are rarest in the scanned files (highest inverse document frequency) and their
positions. A file is looked up by those of its words; the places of both words, each less its
position in the template, are intersected, and the key phrases are verified at what is left. As any
place of a template holds all its key words, nothing is lost, whatever the frequencies are.

Nothing is shuffled but one count per licence word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import read_table
from feedlens.llm.resample import words_sql

#: A word: letters a-z, digits and all signs beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Names of licences whose places are counted, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label and text of further notices; key phrases, all of them mandatory, in brackets.
NOTICES = (
    ("agpl", "[gnu affero general public license]"),
    ("apache", "licensed under the apache license version 2 0 the license [you may not use this "
               "file except in compliance with the license]"),
    ("apache", "you may obtain a copy of the license at http [www apache org licenses license]"),
    ("bsd", "[redistribution and use in source and binary forms] with or without modification "
            "[are permitted provided that the following conditions are met]"),
    ("boost", "[boost software license] version 1 0"),
    ("cc-by", "licensed under [cc by 4 0]"),
    ("cc-by", "[creative commons attribution 4 0] international license"),
    ("cc-by-nc", "licensed under [cc by nc] 4 0"),
    ("cc-by-nc", "[creative commons attribution noncommercial] 4 0 international license"),
    ("cc-by-nd", "licensed under [cc by nd] 4 0"),
    ("cc-by-sa", "licensed under [cc by sa] 4 0"),
    ("cc-by-sa", "[creative commons attribution sharealike] 4 0 international license"),
    ("cc0", "[cc0 1 0] universal"),
    ("epl", "[eclipse public license] v 2 0"),
    ("gpl", "this program is free software [you can redistribute it and or modify it under the "
            "terms of the gnu general public license] as published by the free software foundation"),
    ("isc", "[permission to use copy modify and or distribute this software for any purpose with "
            "or without fee is hereby granted]"),
    ("lgpl", "[gnu lesser general public license]"),
    ("mit", "[permission is hereby granted free of charge to any person obtaining a copy of this "
            "software] and associated documentation files the software to deal in the software "
            "without restriction"),
    ("mpl", "this source code form is subject to the terms of the [mozilla public license] v 2 0"),
    ("unlicense", "[this is free and unencumbered software] released into the public domain"),
    ("zlib", "[this software is provided as is without any express or implied warranty] in no "
             "event will the authors be held liable"),
)


@dataclass(frozen=True)
class Template:
    """A notice: its words, and its key phrases as ``(start, words)``."""

    label: str
    base: bool
    words: tuple[str, ...]
    phrases: tuple[tuple[int, tuple[str, ...]], ...]

    @classmethod
    def of(cls, label: str, text: str, base: bool = False) -> Template:
        words, phrases, start = [], [], None
        for token in text.split():
            if token.startswith("["):
                start = len(words)
            words.append(token.strip("[]"))
            if token.endswith("]"):
                phrases.append((start, tuple(words[start:])))
        return cls(label, base, tuple(words), tuple(phrases))

    def anchors(self, rank: dict[str, int]) -> list[tuple[str, int]]:
        """The two rarest places of the key phrases, as ``(word, position)``."""
        keys = [(word, start + i) for start, words in self.phrases for i, word in enumerate(words)]
        return sorted(keys, key=lambda k: (rank[k[0]], k[1]))[:2]


TEMPLATES = tuple([Template.of(label, f"[{name}]", True) for name, label in BASE]
                  + [Template.of(label, text) for label, text in NOTICES])


def words(text: str | Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def inverse_frequency(files: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """``log((files + 1) / (files with the word + 1))`` per word; ``files`` has ``words``."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    found = files.select(F.explode(F.array_append(F.array_intersect("words", known), F.lit("")))
                         .alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r["word"]: r["n"] for r in found.collect()}
    total = counts.get("", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def _index(templates: tuple[Template, ...], rank: dict[str, int]) -> Column:
    """The templates with their rarest key words, as a literal array."""
    rows = []
    for template in templates:
        (one, at_one), (two, at_two) = template.anchors(rank)
        rows.append(F.struct(
            F.lit(template.label).alias("label"), F.lit(template.base).alias("base"),
            F.lit(one).alias("one"), F.lit(at_one).alias("at_one"),
            F.lit(two).alias("two"), F.lit(at_two).alias("at_two"),
            F.array(*[F.lit(w) for w in template.words]).alias("words"),
            F.array(*[F.struct(F.lit(start).alias("start"),
                               F.array(*[F.lit(w) for w in phrase]).alias("words"))
                      for start, phrase in template.phrases]).alias("phrases")))
    return F.array(*rows)


def _starts(hits: Column, word: Column, position: Column) -> Column:
    """Where the template would start, for each place of a word in the file."""
    return F.transform(F.filter(hits, lambda h: h["word"] == word), lambda h: h["at"] - position)


def _places(hits: Column, template: Column) -> Column:
    """The template's verified places: label, base, start and the share of its words in place."""
    text = F.col("words")
    starts = F.array_intersect(_starts(hits, template["one"], template["at_one"]),
                               _starts(hits, template["two"], template["at_two"]))

    def verified(start: Column) -> Column:
        return F.forall(template["phrases"], lambda p: (start + p["start"] >= 0) & (
            F.slice(text, F.greatest(start + p["start"] + 1, F.lit(1)), F.size(p["words"]))
            == p["words"]))

    def place(start: Column) -> Column:
        same = F.filter(template["words"], lambda w, i: F.get(text, start + i) == w)
        return F.struct(template["label"].alias("label"), template["base"].alias("base"),
                        start.alias("start"),
                        (F.size(same) / F.size(template["words"])).alias("share"))

    return F.transform(F.filter(starts, verified), place)


def scan(files: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words`` and ``places``, an array of verified template places, per row.

    A place is a struct of ``label``, ``base`` (one of the plain names), ``start`` (words from 0;
    negative if the file begins within a notice) and ``share`` of the template's words found in
    place. All rows and all places are kept: repeated rows each, null, empty and blank texts with
    no words. Only ``doc_id`` and ``text`` are read.
    """
    split = files.select("doc_id", words("text").alias("words"))
    keys = sorted({w for t in templates for _, phrase in t.phrases for w in phrase})
    weight = inverse_frequency(split, keys)
    rank = {w: i for i, w in enumerate(sorted(keys, key=lambda w: (-weight[w], w)))}
    rare = sorted({word for t in templates for word, _ in t.anchors(rank)})
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
                    lambda h: h["word"].isin(rare))
    found = F.array(*[F.lit(w) for w in rare])
    hits = F.when(F.arrays_overlap("words", found), hits)
    looked_up = split.withColumn("hits", hits)
    present = F.transform("hits", lambda h: h["word"])
    index = F.filter(_index(templates, rank), lambda t: F.array_contains(present, t["one"])
                     & F.array_contains(present, t["two"]))
    places = F.flatten(F.transform(index, lambda t: _places(F.col("hits"), t)))
    return looked_up.select("doc_id", F.size("words").cast("long").alias("n_words"),
                            F.when(F.col("hits").isNotNull(), places).alias("places"))


def license_report(files: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Licence labels per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``.

    ``n_base`` counts all places of the plain names, ``first_word`` and ``last_word`` are the
    smallest and largest of their starts (null without any). Labels are distinct, sorted and joined
    by commas, empty without any. ``score`` is the largest share of a template's words in place, 0
    without a place.
    """
    none = F.array().cast("array<struct<label:string,base:boolean,start:int,share:double>>")
    found = scan(files, templates).withColumn("places", F.coalesce("places", none))
    found = found.withColumn("base", F.filter("places", lambda p: p["base"]))

    def joined(places: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(f"{places}.label")), ",")

    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        joined("base").alias("base_labels"), joined("places").alias("labels"),
        F.coalesce(F.array_max("places.share"), F.lit(0.0)).alias("score"))


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence names and notices in all documents."""
    return license_report(read_table(spark, sf_dir, "documents"))


def _template_rows() -> str:
    def listed(values) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    return ",\n    ".join(
        f"('{t.label}', {str(t.base).lower()}, {listed(t.words)}, "
        f"{[start for start, _ in t.phrases]}, {[len(p) for _, p in t.phrases]})"
        for t in TEMPLATES)


SQL = f"""
WITH templates(label, base, tw, starts, sizes) AS (VALUES {_template_rows()}),
d AS (SELECT row_number() OVER () AS r, doc_id, {words_sql('text')} AS words FROM documents),
p AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS pos FROM d),
c AS (SELECT d.r, d.words, label, base, tw, starts, sizes, pos - starts[1] AS start
      FROM p JOIN templates ON p.w = tw[starts[1] + 1] JOIN d USING (r)),
v AS (SELECT r, label, base, start,
          len(list_filter(range(len(tw)), lambda i: start + i >= 0
              AND coalesce(words[start + i + 1] = tw[i + 1], false))) / len(tw) AS share
      FROM c WHERE len(list_filter(range(len(starts)), lambda k: start + starts[k + 1] >= 0
          AND words[start + starts[k + 1] + 1 : start + starts[k + 1] + sizes[k + 1]]
              = tw[starts[k + 1] + 1 : starts[k + 1] + sizes[k + 1]])) = len(starts)),
f AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
          max(start) FILTER (base) AS last_word,
          coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
          string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
      FROM v GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
    first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN f USING (r)
"""
