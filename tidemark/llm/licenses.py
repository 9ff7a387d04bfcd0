"""License scans: an exact set-similarity join of text blocks with templates, with DataFrame functions only."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Phrases of which every place counts, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices of well-known licenses.
TEMPLATES = {
    "agpl-notice": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-3-clause": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "gpl-2.0": "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl-notice": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software",
}
#: What tells a license from its neighbours, which share most of their words: it must stand in the block.
TELLING = {
    "agpl-notice": ["affero general public license"],
    "apache-2.0": ["apache license", "2 0"],
    "apache-2.0-notice": ["apache license", "2 0"],
    "bsd-3-clause": ["neither the name"],
    "cc-by-nc-4.0": ["cc by nc", "4 0"],
    "cc-by-sa": ["attribution sharealike"],
    "cc0": ["waived all copyright"],
    "gpl-2.0": ["gnu general public license", "version 2"],
    "gpl-3.0": ["gnu general public license", "version 3"],
    "gpl-notice": ["gnu general public license"],
    "lgpl-notice": ["lesser general public license"],
    "mit": ["mit license"],
    "mpl-2.0": ["mozilla public license", "2 0"],
    "unlicense": ["public domain"],
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: runs of digits, a-z and whatever is not ASCII."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), lambda w: w != "")


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    return {k: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()) for k, t in templates.items()}


def frequencies(docs: DataFrame, tokens: list[str], text_col: str = "text") -> dict[str, int]:
    """In how many documents each of the templates' own tokens stands; at most ``tokens`` rows come to the driver."""
    found = docs.select(F.explode(F.array_intersect(word_array(F.col(text_col)), _array(tokens))).alias("t"))
    return {r["t"]: r["count"] for r in found.groupBy("t").count().collect()}


def _blocks(words: Column, sizes: dict[int, tuple[set[str], int]], vocabulary: Column) -> Column:
    """Candidate blocks of a text, of all sizes: those that hold a prefix token and enough of the templates' tokens.

    ``sizes`` gives for each size the prefix tokens of its templates and the least number of tokens one of them needs.
    Block b of a size has twice as many words, from word b * size on, so every run of ``size`` words lies in one.
    """
    every = sorted(set().union(*(tokens for tokens, _ in sizes.values())))
    at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(every), i)), lambda i: i.isNotNull())

    def of(hits: Column, size: int, tokens: set[str], least: int) -> Column:
        mine = F.filter(hits, lambda i: F.get(words, i).isin(sorted(tokens)))
        number = F.array_distinct(F.flatten(F.transform(mine, lambda i: F.array((i / size).cast("int") - 1, (i / size).cast("int")))))

        def block(b: Column) -> Column:
            ws = F.slice(words, b * size + 1, 2 * size)
            return F.struct(
                F.lit(size).alias("size"), (b * size).alias("start"), F.least(b * size + 2 * size, F.size(words)).alias("end"),
                F.array_intersect(vocabulary, ws).alias("tokens"), F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" ")).alias("spaced"),
            )

        return F.filter(F.transform(F.filter(number, lambda b: b >= 0), block), lambda x: F.size(x["tokens"]) >= least)

    per = F.transform(F.array(at), lambda hits: F.flatten(F.array(*[of(hits, k, *v) for k, v in sizes.items()])))
    return F.get(per, F.lit(0))


def scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None, telling: dict[str, list[str]] | None = None, percent: int = 80,
) -> DataFrame:
    """Places of phrases and labels of templates in each whole text.

    A block is twice as many words as the template has, from each multiple of its number of words on, so that every
    run of as many words lies in a block. A template's label is given where a block holds ``percent`` of its
    distinct tokens or more, and all phrases that tell it from others (``telling``).

    Blocks and templates are joined: tokens are ordered by their frequency in all documents, rarest first, and a
    block that holds ``need`` of a template's n tokens has one of its first n - need + 1 (prefix), ``need`` tokens of
    any template at all (length), and as many from the first common one on in both orders (positional). What passes
    is counted exactly. Only blocks with a prefix token are made; templates are a parameter and so broadcast.

    Returns ``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches)``; matches are
    structs of label, start and end word and share; score is the largest share, 1 with a phrase, else 0. Null text:
    empty. Null and repeated ids: each row is a document of its own. No templates: phrases alone. Empty input: empty
    output.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    telling = TELLING if telling is None else telling
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    tw = template_words(templates)
    vocabulary = sorted({w for ws in tw.values() for w in ws})
    freq = frequencies(docs, vocabulary, text_col) if vocabulary else {}
    vocabulary.sort(key=lambda t: (freq.get(t, 0), t))
    rank = {t: i for i, t in enumerate(vocabulary)}

    heads, sizes = [], {}
    for label, ws in tw.items():
        tokens = sorted(set(ws), key=rank.get)
        need, size = math.ceil(len(tokens) * percent / 100), len(ws)
        prefix = tokens[: len(tokens) - need + 1]
        heads += [(label, size, t, i, tokens, need, [f" {x} " for x in telling.get(label, [])]) for i, t in enumerate(prefix)]
        before, least = sizes.get(size, (set(), need))
        sizes[size] = (before | set(prefix), min(least, need))

    words = F.col("words")
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    some = F.lit(False)
    start = F.when(F.lit(False), F.struct(F.lit(0).alias("at"), F.lit("").alias("label")))

    def starts(w: Column, i: Column) -> Column:
        out = start
        for phrase, label in phrases.items():
            first, *rest = phrase.split()
            here = w == first
            for j, x in enumerate(rest, 1):
                here = here & (F.get(words, i + j) == x)
            out = out.when(here, F.struct(i.alias("at"), F.lit(label).alias("label")))
        return out

    for phrase in phrases:
        some = some | F.col("spaced").contains(f" {phrase} ")
    nothing = F.expr("cast(array() as array<struct<at: int, label: string>>)")
    places = F.when(some, F.filter(F.transform(words, starts), lambda p: p.isNotNull())).otherwise(nothing)

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("k"), F.xxhash64(text, F.lit(1)).alias("h"), word_array(text).alias("words")).withColumn("spaced", spaced)
    slim = rows.select("doc_id", "k", "h", F.size("words").cast("long").alias("n_words"), places.alias("places"), *([_blocks(words, sizes, _array(vocabulary)).alias("blocks")] if heads else []))
    matched = "array<struct<label: string, start: int, end: int, share: double>>"
    if heads:
        slim = scratch.save(slim)
        side = F.broadcast(spark.createDataFrame(heads, "label string, size int, token string, i int, whole array<string>, need int, telling array<string>"))  # a row for each prefix token
        blocks = slim.select("k", "h", F.explode("blocks").alias("b")).select("k", "h", "b.*")
        met = blocks.select("*", F.posexplode("tokens").alias("j", "token")).join(side, ["size", "token"]).where(F.size("tokens") >= F.col("need"))
        # Both sides have one order, so the first token in common is the first in either.
        first = met.groupBy("k", "h", "size", "start", "end", "label", "need", "whole", "telling", "tokens", "spaced").agg(F.min("i").alias("i"), F.min("j").alias("j"))
        first = first.where(F.least(F.size("whole") - F.col("i"), F.size("tokens") - F.col("j")) >= F.col("need"))
        counted = first.withColumn("m", F.size(F.array_intersect("whole", "tokens"))).where("m >= need").where(F.forall("telling", lambda x: F.col("spaced").contains(x)))
        found = counted.groupBy("k", "h").agg(F.array_sort(F.collect_set(F.struct("label", "start", "end", (F.col("m") / F.size("whole")).alias("share")))).alias("matches"))
        out = slim.drop("blocks").join(found, ["k", "h"], "left").withColumn("matches", F.coalesce("matches", F.expr(f"cast(array() as {matched})")))
    else:
        out = slim.withColumn("matches", F.expr(f"cast(array() as {matched})"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(base, F.transform("matches", lambda x: x["label"])))
    at = F.transform("places", lambda p: p["at"].cast("long"))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda x: x["share"])), F.lit(0.0))).alias("score"), "matches",
    )
