"""License scans: phrases, and notices found by voting on diagonals.

Every run of ``GRAM`` words of a text is hashed and joined to the positions of the same run in the
templates, which are license notices. A hit says where in the text the template would have to begin: its
diagonal. Hits are counted by diagonal; diagonals of a template that are close to each other, as words were
put in or left out between them, are merged. A merged span is verified by the template's words that it
covers: only hits whose words are equal, not just their hashes, are counted, and they must cover
``MIN_COVERED`` of the template.

Beside these, the places where the words of a phrase stand one after another are reported.

Everything is made of Spark's own functions. Texts are read twice, once for phrases and once for hits, and
are never shuffled; only hits are, and one short row per document. The templates are broadcast if they
have at most ``MOST_POSITIONS`` positions.

Cases: a null text is an empty one and has no words. Every row counts as a document of its own, whatever its
doc_id. Repeated notices are spans of their own where their diagonals are far apart. An empty table gives
no rows, no templates no notices. Other columns are ignored. A text is one value, and its words are held
in memory together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm import common

GRAM = 4
MIN_COVERED = 0.6
# A diagonal within this share of the template's length of the one before it belongs to the same span.
SLACK = 0.125
# Some 100 bytes each.
MOST_POSITIONS = 100_000
# What a phrase alone says about a text, on the scale of covered shares.
PHRASE_SCORE = 0.5
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of public licenses, as (label, text).
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution.",
    ),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def words_of(text: Column) -> Column:
    """Words in lower case as far as ASCII goes."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(_WORD), 0)


def grams_of(words: Column) -> Column:
    """(at, gram) of every run of ``GRAM`` words, the gram as its words with blanks between."""
    n = F.size(words)

    def gram(at: Column) -> Column:
        run = F.concat_ws(" ", *[F.get(words, at + k) for k in range(GRAM)])
        return F.struct(at.alias("at"), run.alias("gram"))

    return F.when(n >= GRAM, F.transform(F.sequence(F.lit(0), n - GRAM), gram))


def template_positions(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """(hash, template, label, template_words, template_at, template_gram) of every gram of the templates."""
    rows = [
        F.struct(F.lit(number).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"))
        for number, (label, text) in enumerate(templates)
    ]
    listed = F.array(*rows).cast("array<struct<template:int,label:string,text:string>>")
    table = spark.range(1).select(F.inline(listed)).withColumn("words", words_of(F.col("text")))
    grams = table.select("template", "label", F.size("words").alias("template_words"), F.explode(grams_of(F.col("words"))).alias("g"))
    return grams.select(
        F.xxhash64("g.gram").alias("hash"), "template", "label", "template_words",
        F.col("g.at").alias("template_at"), F.col("g.gram").alias("template_gram"),
    )


def notices(docs: DataFrame, key: Sequence[str], templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Key, template, label, first_word, last_word, covered: the verified spans of each row of (key, text)."""
    positions = template_positions(docs.sparkSession, templates)
    if positions.count() <= MOST_POSITIONS:
        positions = F.broadcast(positions)
    # The words are a column of their own, else every gram would split the text again.
    words = docs.select(*key, words_of(common.text_or_empty()).alias("words"))
    grams = words.select(*key, F.explode(grams_of(F.col("words"))).alias("g"))
    hashed = grams.select(*key, F.col("g.at").alias("at"), F.col("g.gram").alias("gram"), F.xxhash64("g.gram").alias("hash"))
    hits = hashed.join(positions, "hash").filter(F.col("gram") == F.col("template_gram"))
    what = [*key, "template", "label", "template_words"]
    votes = hits.groupBy(*what, (F.col("at") - F.col("template_at")).alias("diagonal")).agg(
        F.collect_set("template_at").alias("covered_at"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    order = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.greatest(F.lit(1.0), SLACK * F.col("template_words"))
    numbered = votes.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    numbered = numbered.withColumn("span", F.sum("apart").over(order))
    spans = numbered.groupBy(*what, "span").agg(
        F.array_distinct(F.flatten(F.collect_set("covered_at"))).alias("covered_at"),
        F.min("first").cast("long").alias("first_word"),
        (F.max("last") + GRAM - 1).cast("long").alias("last_word"),
    )
    places = F.flatten(F.transform("covered_at", lambda at: F.sequence(at, at + (GRAM - 1))))
    covered = F.size(F.array_distinct(places)) / F.col("template_words")
    found = spans.select(*key, "template", "label", "first_word", "last_word", covered.alias("covered"))
    return found.filter(F.col("covered") >= MIN_COVERED)


def phrase_places(words: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """(at, label) of every place where the words of a phrase stand one after another."""

    def places(phrase: str, label: str) -> Column:
        parts = phrase.split()
        possible = reduce(lambda a, b: a & b, [F.array_contains(words, part) for part in parts])

        def here(at: Column) -> Column:
            return reduce(lambda a, b: a & b, [F.get(words, at + k) == part for k, part in enumerate(parts)])

        found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
        marked = F.transform(found, lambda at: F.struct(at.cast("long").alias("at"), F.lit(label).alias("label")))
        return F.when(possible, marked).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))

    return F.concat(*[places(phrase, label) for phrase, label in phrases.items()])


def scan(
    docs: DataFrame,
    key: Sequence[str] | None = None,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """doc_id, n_words, places, notices, base_labels, labels and score for every row of (doc_id, text).

    ``key`` names columns that identify a row for good, such as file and position; without it the rows are
    staged under a number. The score is the largest covered share of a notice, and at least
    ``PHRASE_SCORE`` where there is a phrase.
    """
    if key is None:
        key = ["row_id"]
        docs = common.stage(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id")), "license-rows")
    spans = notices(docs, key, templates).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("first_word", "last_word", "label", "template", "covered"))).alias("notices")
    )
    words = docs.select(*key, "doc_id", words_of(common.text_or_empty()).alias("words"))
    base = words.select(
        *key, "doc_id", F.size("words").cast("long").alias("n_words"), phrase_places(F.col("words"), phrases).alias("places")
    )
    joined = base.join(spans, list(key), "left")
    none = F.array().cast("array<struct<first_word:bigint,last_word:bigint,label:string,template:int,covered:double>>")
    full = joined.withColumn("notices", F.coalesce("notices", none))
    base_labels = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    labels = F.concat(F.transform("places", lambda p: p["label"]), F.transform("notices", lambda s: s["label"]))
    best = F.coalesce(F.array_max(F.transform("notices", lambda s: s["covered"])), F.lit(0.0))
    by_phrase = F.when(F.size("places") > 0, PHRASE_SCORE).otherwise(0.0)
    return full.select(
        "doc_id", "n_words", "places", "notices",
        base_labels.alias("base_labels"),
        F.array_sort(F.array_distinct(labels)).alias("labels"),
        F.greatest(best, by_phrase).alias("score"),
    )
