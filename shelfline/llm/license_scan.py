r"""License scan: an exact containment join of text blocks with license templates.

Words are runs of characters other than ASCII control characters, spaces and punctuation, with A-Z
lower-cased. A template is the set of its words; a template of at most S words (S a power of two, 8
at least) is looked for in blocks of 2 S words that begin at every S-th word, so that any place where
it stands lies whole in one block. A block holds a template when it has at least ``PERCENT`` percent
of the template's distinct words; that share is the match's score.

1. One pass counts in how many documents each template word stands. The words of all templates,
   rarest first, are the common order.
2. A block that lacks ``need`` of a template's n words is no match, so a match shares one of the first
   ``n - need + 1`` words of that order with the template, and, with b template words in the block,
   one of the block's first ``b - need + 1`` (prefix filter). Documents without any prefix word are
   passed over, and so are blocks of fewer than ``need`` template words (length filter).
3. Blocks meet templates by an equi-join on (size class, prefix word). A pair whose first common
   word leaves fewer than ``need`` common ones on either side goes (positional filter), the rest
   are compared in full.

All of it is built-in Spark expressions. Only rows of matches shuffle; no text does. The templates
are an argument, so their size is the caller's; their index is broadcast up to ``BROADCAST_WORDS``
words and joined by a shuffle beyond.

Besides, ``PHRASES`` are labels found wherever their words stand consecutively.

Defined results: a null or empty text has no word, place or label and score 0; repeated rows and
null ids each give a row of their own; a phrase counts at every place, also where places overlap;
ties do not matter, as labels are sets and the score is a maximum; an empty table gives an empty
result; other columns are not read, whatever their names; a very long text has as many blocks as its
words ask for and is never cut.
"""

from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import functions as F

from shelfline.llm.common import ascii_lower, stage

PERCENT = 80
LEAST_CLASS = 8
BROADCAST_WORDS = 200_000
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public license notices and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software.""",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2",
        """you may not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
        to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    (
        "cc-by-nc",
        """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International
        License.""",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3",
        """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the
        License, or (at your option) any later version.""",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear
        in all copies.""",
    ),
    (
        "mpl-2",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
]


def words_of(text):
    """The array of words of a text column, empty for NULL."""
    plain = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), GAPS, " "))
    return F.array_remove(F.split(plain, " "), "")


def template_rows(spark, templates, percent=PERCENT):
    """[(number, label, words, size class, need)] of the templates that have a word; a word stands once."""
    given = [F.struct(F.lit(i).alias("number"), F.lit(label).alias("label"), words_of(F.lit(text)).alias("words")) for i, (label, text) in enumerate(templates)]
    if not given:
        return []
    rows = spark.range(1).select(F.inline(F.array(*given))).collect()
    found = []
    for number, label, words in ((r["number"], r["label"], r["words"]) for r in rows):
        if words:
            width = max(LEAST_CLASS, 1 << (len(words) - 1).bit_length())
            distinct = sorted(set(words))
            found.append((number, label, distinct, width, ceil(percent * len(distinct) / 100)))
    return found


def no_blocks():
    return F.array().cast("array<struct<width:int,block:int,held:array<string>>>")


def text_array(values):
    return F.array(*[F.lit(value) for value in values]).cast("array<string>")


def common_order(docs, vocabulary, text_col="text"):
    """The vocabulary, words of fewest documents first. One row per word reaches the driver."""
    held = F.array_intersect(words_of(F.col(text_col)), text_array(vocabulary))
    once = docs.select(F.explode_outer(held).alias("word"))  # a plain explode, or a filter here, splits each text twice
    counts = {row["word"]: row["n"] for row in once.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))


def phrase_places(words, phrases):
    """For each phrase the array of word numbers where it begins."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))

    def starts(parts):
        def stands(i):
            return reduce(and_, [F.get(words, i + step) == part for step, part in enumerate(parts)])

        return F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), stands)

    none = F.array().cast("array<int>")
    return [F.when(joined.contains(f" {phrase} "), starts(phrase.split(" "))).otherwise(none) for phrase in phrases]


def candidate_blocks(words, templates, order, percent=PERCENT):
    """Array of structs (width, block, held): the blocks that may hold a template, and which of its words.

    ``held`` is in the common order: ``array_intersect`` keeps the order of its first argument.
    """
    place = {word: i for i, word in enumerate(order)}

    def of_class(width):
        mine = [row for row in templates if row[3] == width]
        vocabulary = text_array(sorted({word for row in mine for word in row[2]}, key=place.get))
        prefixes = text_array(sorted({word for row in mine for word in prefix(row, place)}))
        least = min(row[4] for row in mine)
        steps = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(words) - 1) / width).cast("int") - 1))

        def block(i):
            held = F.array_intersect(vocabulary, F.slice(words, i * width + 1, F.lit(2 * width)))
            return F.struct(F.lit(width).alias("width"), i.alias("block"), held.alias("held"))

        def possible(b):
            return (F.size(b["held"]) >= least) & F.arrays_overlap(b["held"], prefixes)

        return F.when(F.arrays_overlap(words, prefixes), F.filter(F.transform(steps, block), possible)).otherwise(no_blocks())

    return F.concat(*[of_class(width) for width in sorted({row[3] for row in templates})])


def prefix(row, place):
    """The first words of a template in the common order, one of which any match must share."""
    _, _, words, _, need = row
    return sorted(words, key=place.get)[: len(words) - need + 1]


def template_index(spark, templates, order):
    """One row per template and prefix word, with the word's place and the whole template."""
    place = {word: i for i, word in enumerate(order)}
    rows = []
    for row in templates:
        number, label, words, width, need = row
        for i, word in enumerate(prefix(row, place)):
            rows.append((number, label, width, word, i, len(words), need))
    index = spark.createDataFrame(rows, "number int, label string, width int, word string, at int, n int, need int")
    whole = spark.createDataFrame([(row[0], row[2]) for row in templates], "number int, words array<string>")
    small = sum(len(row[2]) for row in templates) <= BROADCAST_WORDS
    return (F.broadcast(index), F.broadcast(whole)) if small else (index, whole)


def scanned(docs, id_col="doc_id", text_col="text", templates=TEMPLATES, phrases=PHRASES, percent=PERCENT):
    """(rows, matches): a staged row per document with its phrase places, and its template matches.

    ``matches`` has a row (row, label, width, block, score) per block and template.
    """
    spark = docs.sparkSession
    known = template_rows(spark, templates, percent)
    order = common_order(docs, sorted({word for row in known for word in row[2]}), text_col) if known else []
    words = F.col("__words")
    slim = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("__words"))
    places = phrase_places(words, phrases)
    blocks = candidate_blocks(words, known, order, percent) if known else no_blocks()
    rows = slim.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.array(*places).cast("array<array<int>>").alias("places"),
        blocks.alias("blocks"),
    )
    rows = stage(rows, "license-rows")
    if not known:
        return rows, spark.createDataFrame([], "row long, label string, width int, block int, score double")
    index, whole = template_index(spark, known, order)
    block = rows.select("row", F.inline("blocks"))
    tokens = block.select("row", "width", "block", "held", F.size("held").alias("b"), F.posexplode("held").alias("j", "word"))
    overlap_left = 1 + F.least(F.col("n") - F.col("at") - 1, F.col("b") - F.col("j") - 1)
    met = tokens.join(index, ["width", "word"]).where((F.col("b") >= F.col("need")) & (F.col("j") <= F.col("b") - F.col("need")) & (overlap_left >= F.col("need")))
    shared = F.size(F.array_intersect("held", "words"))
    compared = met.join(whole, "number").withColumn("shared", shared).where("shared >= need")
    matches = compared.select("row", "label", "width", "block", (F.col("shared") / F.col("n")).alias("score"))
    return rows, matches.distinct()


def scan_licenses(docs, id_col="doc_id", text_col="text", templates=TEMPLATES, phrases=PHRASES, percent=PERCENT):
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows, matches = scanned(docs, id_col, text_col, templates, phrases, percent)
    found = matches.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    flat = F.flatten("places")
    names = [F.when(F.size(F.get("places", i)) > 0, F.lit(label)) for i, label in enumerate(phrases.values())]
    base = F.array_distinct(F.array_compact(F.array(*names))) if names else F.array().cast("array<string>")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return (
        rows.drop("blocks")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.size(flat).cast("long").alias("n_base"),
            F.array_min(flat).cast("long").alias("first_word"),
            F.array_max(flat).cast("long").alias("last_word"),
            F.array_join(F.array_sort(base), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
            F.when(F.size(flat) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        )
    )
