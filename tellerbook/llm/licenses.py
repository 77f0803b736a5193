"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A block is a paragraph, a template the words of a license notice; the tokens of both are
their distinct runs of five words. A block meets a template if it holds at least
``PERCENT`` hundredths of the template's tokens. The join finds every such pair:

* tokens are ordered by their frequency over all blocks, the rarest first;
* a pair with the needed overlap o shares a token of the template's first
  |T| - o + 1 and of the block's first |B| - o + 1 (prefix filter);
* the block has at least o tokens (length filter), and the shared token's places leave
  room for o common tokens (positional filter);
* what is left is confirmed on the whole sets.

Only tokens of some template can be shared, so blocks hold no others, and a text without
any of the templates' anchor words (see ``anchors``) is not cut up at all. Equal texts are
one text up to the last join. The driver holds the templates and one count for each of
their tokens, whatever the number of documents.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.llm.store import need_columns, stored

#: Words of lower-cased texts: ASCII letters and digits, and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: An empty line, or one of white space, ends a block.
BETWEEN_BLOCKS = r"\n[\x20\x09-\x0D]*\n"
SHINGLE = 5
PERCENT = 80
#: Words of so many letters count as long.
LONG = 7

#: Phrases and their labels (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Labels and the notices that stand for them (fixed values).
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

Templates = tuple[tuple[str, str], ...]


def words_of(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def tokens_of(text: str) -> list[str]:
    """The distinct runs of five words of a template; a shorter one is one token."""
    words = words_of(text)
    return sorted({" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))})


def needed(size: int) -> int:
    """Common tokens that a template of ``size`` tokens asks for."""
    return -(-PERCENT * size // 100)


def anchors(templates: Templates) -> list[str]:
    """Texts one of which every block that meets a template contains.

    A block that meets a template lacks at most |T| - o of its tokens; words are taken
    until the tokens without any of them are fewer than o. Long words, which are rare in
    other texts, come first, and among them those that cover the most tokens.
    """
    wanted = [tokens_of(text) for _, text in templates]
    chosen: list[str] = []

    def uncovered(tokens: list[str]) -> list[str]:
        return [t for t in tokens if not any(word in t for word in chosen)]

    while short := [u for tokens in wanted if len(u := uncovered(tokens)) >= needed(len(tokens))]:
        open_ = [t for tokens in short for t in tokens]
        words = sorted({w for t in short[0] for w in t.split(" ")})
        chosen.append(max(words, key=lambda w: (min(len(w), LONG), sum(w in t for t in open_), len(w))))
    return sorted(chosen)


def _lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"))


def _table(spark: SparkSession, rows: list[dict[str, Column]]) -> DataFrame:
    """A small table of literals."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _block_tokens(documents: DataFrame, templates: Templates, vocabulary: list[str]) -> DataFrame:
    """(digest, block, tokens): the template tokens of each distinct text's blocks."""
    # One pattern, so that the text is lowered once for it and not once for each word.
    anchor = "|".join(re.escape(word) for word in anchors(templates))
    texts = documents.select(_lowered(F.col("text")).alias("lowered")).where(F.col("lowered").rlike(anchor))
    blocks = texts.select(
        F.sha2("lowered", 256).alias("digest"), F.posexplode(F.split("lowered", BETWEEN_BLOCKS)).alias("block", "part")
    ).where(F.col("part").rlike(anchor))
    worded = blocks.select("digest", "block", _words(F.col("part")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (SHINGLE - 1)))
    tokens = F.transform(starts, lambda i: F.array_join(F.slice("w", i, SHINGLE), " "))
    spelt = worded.select("digest", "block", F.explode(tokens).alias("token"))
    numbers = _table(documents.sparkSession, [{"token": F.lit(t), "number": F.lit(i)} for i, t in enumerate(vocabulary)])
    return spelt.join(numbers, "token").groupBy("digest", "block").agg(F.collect_set("number").alias("tokens"))


def _prefixes(spark: SparkSession, templates: Templates, ranks: dict[str, int]) -> DataFrame:
    """One row for each token in a template's prefix."""
    rows = []
    for number, (label, text) in enumerate(templates):
        own = sorted(ranks[t] for t in tokens_of(text))
        need = needed(len(own))
        for place, rank in enumerate(own[: len(own) - need + 1]):
            rows.append(
                {
                    "rank": F.lit(rank), "template": F.lit(number), "label": F.lit(label), "place": F.lit(place),
                    "need": F.lit(need), "whole": F.array(*[F.lit(r) for r in own]),
                }
            )
    return _table(spark, rows)


def matching_blocks(documents: DataFrame, templates: Templates = TEMPLATES) -> DataFrame:
    """Every block and template that meet: digest (of the lower-cased text), block, template, label, containment."""
    spark = documents.sparkSession
    vocabulary = sorted({t for _, text in templates for t in tokens_of(text)})
    blocks = stored(_block_tokens(documents, templates, vocabulary), "license-blocks")
    # One row for each token of the templates.
    counts = dict(blocks.select(F.explode("tokens").alias("t")).groupBy("t").count().collect())
    order = sorted(range(len(vocabulary)), key=lambda t: (counts.get(t, 0), t))
    ranks = {vocabulary[t]: rank for rank, t in enumerate(order)}
    by_number = F.array(*[F.lit(ranks[t]) for t in vocabulary])
    ordered = blocks.select("digest", "block", F.array_sort(F.transform("tokens", lambda t: F.get(by_number, t))).alias("own"))
    size = F.size("own")
    placed = ordered.select("digest", "block", "own", size.alias("size"), F.posexplode("own").alias("at", "rank"))

    room = F.least("at", "place") + 1 + F.least(F.size("whole") - F.col("place"), F.col("size") - F.col("at")) - 1
    fits = (F.col("size") >= F.col("need")) & (F.col("at") <= F.col("size") - F.col("need")) & (room >= F.col("need"))
    candidates = placed.join(_prefixes(spark, templates, ranks), "rank").where(fits)
    once = candidates.dropDuplicates(["digest", "block", "template"])
    shared = F.size(F.array_intersect("own", "whole"))
    return once.where(shared >= F.col("need")).select(
        "digest", "block", "template", "label", (shared / F.size("whole")).alias("containment")
    )


def _places(phrase: str, label: str) -> Column:
    """Where the phrase's words stand one after the other, first words' numbers."""
    words = phrase.split(" ")

    def here(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.get("w", i + k) == F.lit(word) for k, word in enumerate(words)])

    starts = F.sequence(F.lit(0), F.size("w") - len(words))
    found = F.transform(F.filter(starts, here), lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))
    there = (F.size("w") >= len(words)) & F.array_contains("w", words[-1])
    return F.when(there, found).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))


def scan_licenses(
    documents: DataFrame, templates: Templates = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES
) -> DataFrame:
    """The license phrases of every document and the templates that its blocks meet.

    Returns doc_id, n_words, places (word number and label of each phrase), matches
    (block number, label and containment of each template met), labels (of both,
    distinct, sorted) and score, the greatest containment, 0.0 without a match.

    Null, empty and blank texts have no words, places or matches. Texts are taken whole;
    a text without an empty line is one block, of any length. Null and repeated ids are
    rows of their own; further columns play no part; an empty table stays empty. A block
    that meets several templates has a match for each.
    """
    rows = need_columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    met = (
        matching_blocks(rows, templates)
        .groupBy("digest")
        .agg(F.array_sort(F.collect_list(F.struct("block", "label", "containment"))).alias("matches"))
    )
    worded = rows.select("doc_id", _lowered(F.col("text")).alias("lowered")).select(
        "doc_id", F.sha2("lowered", 256).alias("digest"), _words(F.col("lowered")).alias("w")
    )
    based = worded.select(
        "doc_id", "digest", F.size("w").cast("long").alias("n_words"),
        F.array_sort(F.concat(*[_places(*p) for p in phrases])).alias("places"),
    )
    none = F.array().cast("array<struct<block:int,label:string,containment:double>>")
    joined = based.join(met, "digest", "left").withColumn("matches", F.coalesce("matches", none))
    return joined.select(
        "doc_id", "n_words", "places", "matches",
        F.array_sort(F.array_union("places.label", "matches.label")).alias("labels"),
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("score"),
    )
