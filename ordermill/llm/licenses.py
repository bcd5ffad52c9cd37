"""License scan: named phrases, and an exact set-similarity join of text blocks with license templates.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.

Base rules find the places where the words of a phrase stand one after the other. The join finds every block of a text
that holds at least ``CONTAINMENT`` of a template's distinct words. A template of n words is compared with blocks
of 2 L words that begin every L words, L being the power of two at or above n, so any place where it may stand lies
in a block. Words are ordered by the number of documents that hold them, rarest first. A block that reaches
the threshold holds one of the template's first |T| - ceil(c |T|) + 1 words (prefix filter), as many template words as the
threshold asks for at least (length filter), and, counted from the first common word on, enough words on both
sides (position filter); what is left is verified by counting the common words. All is done with DataFrame functions.

Null and empty texts have no words and no labels. Repeated rows are scanned alike and give a row each, as do rows
without doc_id. Labels are sorted and distinct, so ties do not matter. Other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linking import stored

CONTAINMENT = 0.8

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices of common licenses, label and text.
TEMPLATES = (
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
     "option) any later version."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
     "purpose, commercial or non-commercial, and by any means."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in order; none for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(plain, _BREAK), "")


def _phrase_places(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    return F.filter(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda i: reduce(lambda a, b: a & b, (F.get(words, i + k) == p for k, p in enumerate(parts))),
    )


def _template_table(spark, templates, containment: float) -> DataFrame:
    """One row per template and distinct word: template, label, n (distinct words), least (common words needed), span, word."""
    rows = []
    for number, (label, text) in enumerate(templates):
        tokens = "".join(c.lower() if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text).split()
        distinct = sorted(set(tokens))
        span = 1 << max(0, len(tokens) - 1).bit_length()
        # Rounded down a little, as 0.8 * 5 must ask for 4 words.
        least = max(1, math.ceil(containment * len(distinct) - 1e-9))
        rows += [(number, label, len(distinct), least, span, word) for word in distinct]
    return spark.createDataFrame(rows, "template int, label string, n int, least int, span int, word string")


def _needs(table: DataFrame) -> list[tuple[list[str], int]]:
    """Distinct words of each template and the number of them that a block needs."""
    needs: dict[int, tuple[list[str], int]] = {}
    for row in table.collect():
        needs.setdefault(row["template"], ([], row["least"]))[0].append(row["word"])
    return list(needs.values())


def scan(docs: DataFrame, templates=TEMPLATES, phrases=None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    ``matches`` are the blocks that reach the threshold: (label, first_word, n_words, containment). ``score`` is the largest
    containment found, 1 where a phrase stands, else 0.
    """
    phrases = PHRASES if phrases is None else phrases
    spark = docs.sparkSession
    # A template list is a parameter of the size of a source file, and so is its table.
    table = _template_table(spark, templates, containment)
    needs = _needs(table)
    vocabulary = sorted({w for have, _ in needs for w in have})
    words = F.col("words")
    rows = docs.select(F.col("doc_id").cast("long"), words_of(F.col("text").cast("string")).alias("words"))
    # Only the places of words that templates or phrases have go on from here.
    firsts = {p.split()[0] for p in phrases}
    marked = rows.select("doc_id", "words", F.size(words).cast("long").alias("n_words"),
                         F.array_intersect(words, F.array(*map(F.lit, vocabulary))).alias("held"),
                         F.arrays_overlap(words, F.array(*map(F.lit, sorted(firsts)))).alias("named"))
    none = F.array().cast("array<int>")
    places = {p: F.when(F.col("named"), _phrase_places(words, p)).otherwise(none) for p in phrases}
    # A text that lacks a template's words as a whole has no block with them.
    likely = reduce(
        lambda a, b: a | b,
        (F.size(F.array_intersect("held", F.array(*map(F.lit, have)))) >= least for have, least in needs),
        F.lit(False),
    )
    position = F.when(
        likely,
        F.filter(
            F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
            lambda x: F.array_contains(F.col("held"), x["word"]),
        ),
    ).otherwise(F.array().cast("array<struct<word:string,at:int>>"))
    found = stored(
        marked.select(
            "doc_id", "n_words", F.monotonically_increasing_id().alias("row"), position.alias("places"), "held",
            *(v.alias(f"_{i}") for i, v in enumerate(places.values())),
        ),
        "places",
    )
    matches = _matches(found, table)
    all_places = F.array_sort(F.flatten(F.array(*(F.col(f"_{i}") for i in range(len(phrases))))))
    base = F.array_compact(F.array(*(
        F.when(F.size(f"_{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())
    )))
    by_row = matches.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("label", "first_word", "n_words", "containment"))).alias("matches"),
        F.max("containment").alias("best"),
    )
    joined = found.withColumn("all", all_places).withColumn("base", F.array_sort(F.array_distinct(base)))
    joined = joined.join(by_row, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce(F.col("matches.label"), F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", F.size("all").cast("long").alias("n_base"),
        F.get("all", F.lit(0)).cast("long").alias("first_word"),
        F.get("all", F.size("all") - 1).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"), "matches",
    )


def _matches(found: DataFrame, table: DataFrame) -> DataFrame:
    """(row, label, first_word, n_words, containment) of every block and template that reach the threshold."""
    frequency = found.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    ordered = table.select("word").distinct().join(frequency, "word", "left").select(
        "word", F.struct(F.coalesce("df", F.lit(0)), "word").alias("rank")
    )
    # Rank of each template word in its template, rarest first; the table has as many rows as the templates have words.
    ranked = table.join(ordered, "word")
    sets = ranked.groupBy("template", "label", "n", "least", "span").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))
    sets = stored(sets, "templates")
    prefix = F.posexplode(F.slice("ranks", F.lit(1), F.col("n") - F.col("least") + 1)).alias("i", "rank")
    entries = sets.select("template", "label", "n", "least", "span", prefix).select("*", F.col("rank.word").alias("word"))
    places = found.select("row", "n_words", F.explode("places").alias("p")).select("row", "n_words", "p.word", "p.at")
    places = places.join(F.broadcast(ordered), "word")
    spans = sets.select("span").distinct()
    first = F.floor(F.col("at") / F.col("span")).cast("long")
    in_blocks = places.crossJoin(F.broadcast(spans)).withColumn(
        "block", F.explode(F.when(first > 0, F.array(first - 1, first)).otherwise(F.array(first)))
    )
    blocks = in_blocks.groupBy("row", "n_words", "span", "block").agg(F.array_sort(F.collect_set("rank")).alias("own"))
    lead = blocks.select("*", F.posexplode("own").alias("j", "rank")).withColumn("word", F.col("rank.word"))
    room = 1 + F.least(F.col("n") - F.col("i"), F.size("own") - F.col("j")) - 1
    candidates = (
        lead.join(F.broadcast(entries.drop("rank")), ["span", "word"])
        .where((F.size("own") >= F.col("least")) & (room >= F.col("least")))
        .select("row", "n_words", "span", "block", "own", "template").distinct()
    )
    verified = candidates.join(F.broadcast(sets.drop("span")), "template").withColumn(
        "common", F.size(F.array_intersect("own", "ranks"))
    )
    begin = F.col("block") * F.col("span")
    return verified.where(F.col("common") >= F.col("least")).select(
        "row", "label", begin.alias("first_word"),
        F.least(F.lit(2).cast("long") * F.col("span"), F.col("n_words") - begin).alias("n_words"),
        (F.col("common") / F.col("n")).alias("containment"),
    )
