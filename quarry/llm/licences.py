"""Licence scans through a positional index of rare words.

The index lists, for every word of the licence templates, the templates and the
places in them.  Words are ranked by inverse document frequency over all files.
A file is searched by its licence words of highest IDF only: those that are among
the rarest of some template (its anchors).  Each of their places in the file, less
the place in a posting, says where that template would begin; a template is a
candidate where its anchor puts it (phrases) or where enough of its anchors agree
up to a few words (notices, which may have words put in or left out).  Candidates are then
verified: a phrase must stand there word by word, a notice must have all its key
phrases.  All of it is column expressions over one row, and nothing but the word
counts is shuffled, so hot sources and groups of copies cost no more than others.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters between words of a lower-cased text.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Anchors of a notice, and how many must agree.
ANCHORS = 8
AGREE = 4
#: Words by which agreeing places may differ, and words searched for key phrases
#: on both sides of a notice's place.
DRIFT = 8
MARGIN = 16


@dataclass(frozen=True)
class Template:
    """A licence text.  A phrase (without ``keys``) is found word by word; a
    notice by its place, if all ``keys`` stand in it."""

    label: str
    text: str
    keys: tuple[str, ...] = ()

    @property
    def words(self) -> list[str]:
        return re.findall("[0-9a-z]+", self.text.lower())


#: Fixed phrases (the base) and their labels.
BASE = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)
#: Names by which other licences, or the same in other words, are referred to.
NAMES = (
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl-2.1", "gnu lesser general public license version 2 1"),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2 0"),
    Template("mpl-2", "mozilla public license v 2 0"),
    Template("epl-2", "eclipse public license 2 0"),
    Template("epl-2", "eclipse public license v 2 0"),
    Template("bsd-2", "bsd 2 clause license"),
    Template("bsd-3", "bsd 3 clause license"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc0", "cc0 1 0 universal"),
    Template("apache-2", "spdx license identifier apache 2 0"),
    Template("mit", "spdx license identifier mit"),
    Template("gpl-2", "spdx license identifier gpl 2 0"),
    Template("gpl-3", "spdx license identifier gpl 3 0"),
)
#: Notices of public licences, with the phrases that none of them lacks.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
             "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies",
             ("for any purpose with or without fee", "permission notice appear in all copies")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
             "compliance with the License. You may obtain a copy of the License at",
             ("licensed under the apache license version 2 0", "except in compliance with the license")),
    Template("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) "
             "any later version", ("gnu general public license as published by", "version 2 of the license")),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
             "any later version", ("gnu general public license as published by", "version 3 of the license")),
    Template("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
             "option) any later version", ("gnu lesser general public license as published by", "version 2 1 of the license")),
    Template("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
             "option) any later version", ("gnu affero general public license as published by", "version 3 of the license")),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
             "not distributed with this file, You can obtain one at",
             ("terms of the mozilla public license", "if a copy of the mpl was not distributed with this file")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
             "conditions and the following disclaimer",
             ("redistribution and use in source and binary forms", "must retain the above copyright notice")),
    Template("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
             "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
             "and transmit the Software, and to prepare derivative works of the Software",
             ("documentation covered by this license", "to use reproduce display distribute execute and transmit the software")),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
             "any purpose, including commercial applications",
             ("provided as is without any express or implied warranty", "including commercial applications")),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
             "publish, use, compile, sell, or distribute this software",
             ("free and unencumbered software released into the public domain",)),
)


# The index --------------------------------------------------------------------

def word_list(text: Column) -> Column:
    """The words of a text, A-Z as a-z.  ``lower`` turns no other character into one
    of a-z but the Kelvin sign."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.contains(text, F.lit("\u212a")), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, BETWEEN), "")


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def inverse_frequency(docs: DataFrame, words: list[str], text: str = "text") -> dict[str, float]:
    """IDF of each of ``words`` over all rows of ``docs``: the logarithm of the rows by
    those with the word, each plus one.  Only one count per word of the templates
    and the number of rows reach the driver."""
    held = docs.select(F.array_intersect(word_list(F.col(f"`{text}`")), strings(words)).alias("_w"))
    # the empty word stands for the row itself
    counts = held.select(F.explode(F.concat(strings([""]), "_w")).alias("word")).groupBy("word").count()
    found = {r["word"]: r["count"] for r in counts.collect()}
    return {w: math.log((1 + found.get("", 0)) / (1 + found.get(w, 0))) for w in words}


@dataclass(frozen=True)
class Index:
    """The templates, by the words that they are searched by."""

    templates: tuple[Template, ...]
    idf: dict[str, float]

    def anchors(self, template: Template) -> list[str]:
        """The rarest words of a template: one of a phrase, ``ANCHORS`` of a notice;
        of equally rare ones the longer, then the smaller."""
        ranked = sorted(set(template.words), key=lambda w: (-self.idf[w], -len(w), w))
        return ranked[: ANCHORS if template.keys else 1]

    def postings(self, template: Template) -> dict[str, list[int]]:
        """The places of each anchor in the template."""
        return {w: [i for i, x in enumerate(template.words) if x == w] for w in self.anchors(template)}


# Scan ---------------------------------------------------------------------------

PLACE = "struct<label:string,first:bigint,end:bigint,base:boolean,score:double>"


def begins(postings: dict[str, list[int]]) -> Column:
    """Where each hit would have the template begin, ascending."""
    hits = F.filter("_hits", lambda h: h["word"].isin(list(postings)))
    places = F.create_map(*[x for w, at in postings.items() for x in (F.lit(w), F.array(*[F.lit(i) for i in at]))])
    return F.array_sort(F.flatten(F.transform(hits, lambda h: F.transform(places[h["word"]], lambda i: h["at"] - i))))


def place(template: Template, first: Column, end: Column, base: bool, score: Column) -> Column:
    return F.struct(F.lit(template.label).alias("label"), first.cast("long").alias("first"), end.cast("long").alias("end"),
                    F.lit(base).alias("base"), score.alias("score"))


def part(first: Column, size: int) -> Column:
    """``size`` words of the file from ``first`` on (from 0), or as many as there are."""
    from_ = F.greatest(first, F.lit(0))
    return F.array_join(F.slice("_words", from_.cast("int") + 1, F.greatest(first + size - from_, F.lit(0)).cast("int")), " ")


def phrase_places(template: Template, base: bool, starts: Column) -> Column:
    """The places of a phrase: where its anchor has it begin, if it stands there."""
    words, size = template.words, len(template.words)
    there = F.filter(starts, lambda s: (s >= 0) & (part(s, size) == " ".join(words)))
    return F.transform(there, lambda s: place(template, s, s + size, base, F.lit(1.0)))


def agreeing(starts: Column, enough: int) -> Column:
    """The begins from which on ``enough`` lie within ``DRIFT`` words."""
    ends = F.slice(starts, enough, F.greatest(F.size(starts), F.lit(1)))
    return F.array_compact(F.zip_with(starts, ends, lambda a, b: F.when(b - a <= DRIFT, a)))


def notice_places(template: Template, idf: dict[str, float], found: Column) -> Column:
    """The places of a notice: of candidates within a drift the first, if all key
    phrases stand around it."""
    words, size = template.words, len(template.words)
    before = F.concat(F.array(F.lit(None).cast("int")), found)
    first = F.array_compact(F.zip_with(found, before, lambda s, p: F.when(p.isNull() | (s - p > DRIFT), s)))
    around = F.transform(first, lambda s: F.struct(
        s.alias("s"), F.concat(F.lit(" "), part(s - MARGIN, size + DRIFT + 2 * MARGIN), F.lit(" ")).alias("words")))
    there = F.filter(around, lambda x: reduce(and_, [F.contains(x["words"], F.lit(f" {key} ")) for key in template.keys]))
    weight = sum(1 + idf[w] for w in set(words))
    known = F.create_map(*[x for w in sorted(set(words)) for x in (F.lit(w), F.lit((1 + idf[w]) / weight))])
    share = lambda x: F.aggregate(F.array_intersect(F.split(x["words"], " "), strings(sorted(set(words)))), F.lit(0.0),
                                  lambda total, w: total + known[w])
    return F.transform(there, lambda x: place(template, F.greatest(x["s"], F.lit(0)), F.greatest(x["s"], F.lit(0)) + size, False,
                                              F.least(share(x), F.lit(1.0))))


def scan_licences(docs: DataFrame, base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = NAMES + NOTICES,
                  text: str = "text") -> DataFrame:
    """(doc_id, n_words, places) per row of ``docs``: the licences found as (label,
    first, end, base, score), sorted; ``first`` and ``end`` count words from 0.

    A phrase scores 1, a notice the share of its words, each of weight 1 + IDF, that
    stand around its place.  A null or empty text has no words and no places; a text of
    any length is searched whole.  Every row is judged by itself but for the
    document frequencies: repeated rows and null ids keep their rows.  Columns of
    ``docs`` other than doc_id and the text are not read.
    """
    index = Index(base + more, inverse_frequency(docs, vocabulary(base + more), text))
    anchors = sorted({w for t in index.templates for w in index.anchors(t)})
    rows = docs.select("doc_id", word_list(F.col(f"`{text}`")).alias("_words"))
    hits = F.filter(F.transform("_words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda h: h["word"].isin(anchors))
    # files without an anchor have null hits, and null in all that follows
    rows = rows.withColumn("_hits", F.when(F.arrays_overlap("_words", strings(anchors)), hits))
    every = list(enumerate(index.templates))
    rows = rows.withColumns({f"_begin{k}": begins(index.postings(t)) for k, t in every})
    rows = rows.withColumns({f"_begin{k}": agreeing(F.col(f"_begin{k}"), min(AGREE, len(index.anchors(t)))) for k, t in every if t.keys})
    none = F.array().cast(f"array<{PLACE}>")
    found = [notice_places(t, index.idf, F.col(f"_begin{k}")) if t.keys else phrase_places(t, k < len(base), F.col(f"_begin{k}"))
             for k, t in every]
    places = F.when(F.col("_hits").isNotNull(), F.array_sort(F.concat(*[F.coalesce(x, none) for x in found]))).otherwise(none)
    return rows.select("doc_id", F.size("_words").cast("long").alias("n_words"), places.alias("places"))


def licence_digests(scanned: DataFrame) -> DataFrame:
    """Counts and labels per row of :func:`scan_licences`: n_words; n_base, first_word
    and last_word of the base phrases (null: none); base_labels and labels, sorted
    and joined by commas; score, the best of the places' (0: none)."""
    own = F.filter("places", lambda p: p["base"])
    rows = scanned.select("doc_id", "n_words", "places", own.alias("_base"))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    firsts = F.transform("_base", lambda p: p["first"])
    return rows.select(
        "doc_id", "n_words", F.size("_base").cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"), labels(F.col("_base")).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"))
