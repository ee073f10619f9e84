"""License scan by exact set-similarity join of text blocks with license templates.

A template is a license notice as a set of words.  A block is a run of consecutive words of a text, wherever its lines
break, a quarter longer than the notice; all such runs are blocks.  A text carries a template's label if one of its
blocks holds at least ``THRESHOLD`` of the template's words.  The join is exact: tokens are ordered by document
frequency over the whole corpus, rarest first; a block that reaches the threshold must hold a word of the template's
prefix (the words without which too few are left), there must be enough words (length filter), and enough of the
template's words must stand within a block's length of the prefix word (positional filter).  The rest is verified.

Only DataFrame functions: texts without a prefix word are never cut into words for this, and templates are a constant
table.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that end a word, phrases that label a document outright, and templates of notices.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
TEMPLATES = {
    "agpl-3": ("gnu affero general public license version 3",),
    "all-rights-reserved": ("all rights reserved",),
    "apache-2": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ),
    "bsl-1": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation "
        "covered by this license the software to use reproduce display distribute execute and transmit the software",
    ),
    "cc-by-nc": ("licensed under cc by nc 4 0", "licensed under the creative commons attribution noncommercial license"),
    "cc-by-sa": ("licensed under the creative commons attribution sharealike license",),
    "cc0": ("to the extent possible under law has waived all copyright and related or neighboring rights to this work",),
    "epl-2": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation",
    ),
    "gpl-3": ("this work is licensed under the gnu general public license version 3",),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "lgpl": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
        "by the free software foundation",
    ),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software",
    ),
    "mpl-2": (
        "subject to the terms of the mozilla public license v 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ),
    "public-domain": ("this work is released into the public domain",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising "
        "from the use of this software",
    ),
}
THRESHOLD = 0.9


def templates_of(notices: dict[str, tuple[str, ...]], threshold: float) -> list[tuple[str, list[str], int, int]]:
    """(label, distinct words, words that a block must hold, words of a block) of every notice."""
    out = []
    for label, texts in notices.items():
        for text in texts:
            words = sorted(set(text.split()))
            out.append((label, words, ceil(threshold * len(words) - 1e-9), ceil(1.25 * len(text.split()))))
    return out


def flattened(text: Column) -> Column:
    """The text's words with one space between them, letters as they are.  Null gives an empty string."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_WORD, " "))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(flat: Column) -> Column:
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def starts_of(words: Column, phrase: str) -> Column:
    """Word positions, from 0, at which the phrase's words stand one after another."""
    parts = phrase.split()
    wanted = F.array(*map(F.lit, parts))

    def places(ws: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(ws) - F.lit(len(parts))), lambda i: F.slice(ws, i + 1, len(parts)) == wanted)

    # bound to a lambda variable, the words are worked out once a text and not once a place
    return F.element_at(F.transform(F.array(words), places), 1)


def token_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> list[str]:
    """The templates' words, rarest first by the number of documents of the corpus with the word, ties by the word."""
    known = F.array(*map(F.lit, vocabulary))
    words = F.array_intersect(F.split(F.lower(flattened(F.col(text_col))), " "), known)
    seen = docs.select(F.explode(words).alias("w")).groupBy("w").count()
    counts = {r.w: r["count"] for r in seen.collect()}  # at most one row a template word
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _near(words: Column, wanted: Column, reach: int) -> Column:
    """(token, at, near) of every place of a wanted word: the words up to ``reach`` - 1 places off, and its place in them."""

    def places(ws: Column) -> Column:
        numbered = F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        found = F.filter(numbered, lambda x: F.array_contains(wanted, x["w"]))
        before = lambda x: F.least(x["i"], F.lit(reach - 1))
        return F.transform(
            found,
            lambda x: F.struct(x["w"].alias("token"), before(x).alias("at"), F.slice(ws, x["i"] - before(x) + 1, before(x) + reach).alias("near")),
        )

    # bound to a lambda variable, the words are worked out once a text
    return F.element_at(F.transform(F.array(words), places), 1)


def template_blocks(
    docs: DataFrame, *, key: tuple[str, ...] = ("doc_id",), text_col: str = "text",
    templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """(*key, label, containment): what the best block around a prefix word holds, if ``threshold`` of a template's words.

    A pair comes once for each place of a prefix word.
    """
    spark = docs.sparkSession
    known = templates_of(templates or TEMPLATES, threshold)
    order = {w: i for i, w in enumerate(token_order(docs, sorted({w for _, ws, _, _ in known for w in ws}), text_col))}
    rows = []
    for label, ws, need, width in known:
        ranked = sorted(ws, key=order.__getitem__)
        rows += [(label, w, need, width, len(ws), ranked) for w in ranked[: len(ws) - need + 1]]
    prefixes = spark.createDataFrame(rows, "label string, token string, need int, width int, n int, ranked array<string>")
    firsts = sorted({r[1] for r in rows})
    # a text without the letters of any prefix word holds no candidate: it is not cut into words
    low = F.lower(F.col(text_col))
    possible = low.contains(firsts[0])
    for w in firsts[1:]:
        possible = possible | low.contains(w)
    words = _words(ascii_lower(flattened(F.col(text_col))))
    places = docs.where(possible).select(*key, F.explode(_near(words, F.array(*map(F.lit, firsts)), max(r[3] for r in rows))).alias("x"))
    before = F.least("x.at", F.col("width") - 1)
    candidates = (
        places.join(F.broadcast(prefixes), F.col("x.token") == F.col("token"))  # a constant table of some dozens of rows
        # positional: only words within a block's length of the prefix word can share a block with it
        .withColumn("block", F.slice("x.near", F.col("x.at") - before + 1, before + F.col("width")))
        .where(F.size("block") >= F.col("need"))  # length
        .where(F.size(F.array_intersect("ranked", "block")) >= F.col("need"))
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("block") - F.col("width") + 1, F.lit(1)))
    most = F.array_max(F.transform(starts, lambda s: F.size(F.array_intersect("ranked", F.slice("block", s, F.col("width"))))))
    found = candidates.withColumn("most", most).where(F.col("most") >= F.col("need"))
    return found.select(*key, "label", (F.col("most") / F.col("n")).alias("containment"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base labels come from the phrases, labels from phrases and templates.  ``score`` is 1 with a phrase, else the
    largest containment found, else 0.  Null and empty texts have no words; repeated rows are scanned each; labels are
    in order, joined by commas, and empty if there are none.  An empty table gives an empty result; other columns are
    not read.
    """
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    hits = (
        template_blocks(text, key=("doc_id", "h"))
        .groupBy(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"))
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("most"))
    )
    flat = text.withColumn("flat", flattened(F.col("text"))).drop("text")
    low = F.concat(F.lit(" "), F.lower("flat"), F.lit(" "))
    words = _words(ascii_lower(F.col("flat")))
    none = F.array().cast("array<int>")
    for i, phrase in enumerate(PHRASES.values()):
        # positions are worked out only where the phrase stands at all
        flat = flat.withColumn(f"at{i}", F.when(low.contains(f" {phrase} "), starts_of(words, phrase)).otherwise(none))
    base = flat.select(
        "doc_id", "h", F.when(F.col("flat") == "", 0).otherwise(F.size(F.split("flat", " "))).cast("long").alias("n_words"),
        F.concat(*[f"at{i}" for i in range(len(PHRASES))]).alias("at"),
        F.array_compact(F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(k)) for i, k in enumerate(PHRASES)])).alias("base"),
    )
    joined = base.join(hits, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("h") == F.col("k_h")), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )
