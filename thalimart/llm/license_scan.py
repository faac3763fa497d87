"""License notices found by MinHash bands over overlapping text windows.

Only DataFrame expressions run; the templates are the fixed list below.

1. Texts become lower-cased words (runs of letters and digits). Every ``STRIDE``
   words a window of ``WINDOW`` words begins; windows overlap, so any run of
   ``WINDOW`` - ``STRIDE`` + 1 words lies whole in some window.
2. Templates are cut the same way at every word, short ones are one window.
3. A window's ``BANDS`` minima over the hashes of its runs of ``SHINGLE`` words are
   its bands, of one row each; h XOR mask orders the hashes anew for every band.
   A window that holds a five-word notice shares three of its four runs with it,
   so it meets the notice with probability 1 - 4^-BANDS > 0.9997, and a window
   inside an unchanged longer notice equals one of its windows and meets it
   always. Windows without a known minimum end here; the template bands (a
   constant list) are in the filter itself and in one broadcast.
4. Around every window that is left, the words that can belong to the template
   are compared exactly: the share of the template's runs that occur there
   (containment) must reach ``CONTAINMENT``.

Nothing is shuffled before the verified matches, so a notice in a third of all
documents costs its own windows only.

Defined results: null and empty texts and texts under ``SHINGLE`` words match
nothing; one row per doc_id and license with its best containment and the first
such place, rows that share an id (null too) together; long texts are scanned
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 3
WINDOW = 6
STRIDE = 2
BANDS = 6
CONTAINMENT = 0.8
#: Words around a window that are compared with a template of n words: n to
#: either side and some room for inserted words.
ROOM = 4

# fixed values: notices as their licences and licence guides word them
TEMPLATES = {
    "MIT": ["Released under the MIT License.",
            "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "GPL-2.0": ["under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "LGPL": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL-3.0": ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "EPL-2.0": ["made available under the terms of the Eclipse Public License 2.0"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "proprietary": ["All rights reserved. No part of this publication may be reproduced"],
}

WORD = "[^\\p{L}\\p{N}]++"


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(F.lower(text), WORD), "")


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def template_rows() -> list[tuple[str, int, list[str]]]:
    """license, number of the notice, its words."""
    return [(name, n, found) for name, notices in TEMPLATES.items()
            for n, notice in enumerate(notices) if len(found := template_words(notice)) >= SHINGLE]


def masks() -> list[int]:
    """One mask per band. Their leading bits differ, so each band prefers other
    hashes; a linear congruence gives the rest."""
    out, x = [], 0x243F6A8885A308D3
    for i in range(BANDS):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        mask = (i * (1 << 60) ^ x >> 4) % (1 << 64)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def run_hashes(words: Column) -> Column:
    """Hashes of the runs of ``SHINGLE`` words, one per place; empty for shorter
    texts. Loops over arrays keep the generated code small enough to be compiled."""
    places = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(0), F.size(words) - SHINGLE)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))


def bands(runs: Column, at: Column) -> list[Column]:
    """Of the window that begins at run ``at``: the minimum of its hashes in the
    order of every mask."""
    own = [F.get(runs, at + j) for j in range(WINDOW - SHINGLE + 1)]
    return [F.least(*[h.bitwiseXOR(F.lit(m)) for h in own]) for m in masks()]


def known_bands(spark: SparkSession) -> DataFrame:
    """band, key, license, notice, template words and all keys of the notice, for
    every window of every template: a constant number of rows, made by the same
    expressions as the documents' bands."""
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(n).alias("notice"), F.array(*map(F.lit, words)).alias("template"))
                     for name, n, words in template_rows()])
    notices = spark.range(1).select(F.inline(rows))
    cut = notices.withColumn("runs", run_hashes(F.col("template"))).select("*", F.explode(
        F.sequence(F.lit(0), F.greatest(F.size("template") - WINDOW, F.lit(0)))).alias("at"))
    own = F.array(*bands(F.col("runs"), F.col("at")))
    windows = cut.select("license", "notice", "template", F.posexplode(own).alias("band", "key")).distinct()
    whole = windows.groupBy("license", "notice").agg(F.collect_set("key").alias("notice_keys"))
    return windows.join(whole, ["license", "notice"])


def scan(docs: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, containment, first_word."""
    longest = max(len(words) for _, _, words in template_rows())
    known = known_bands(docs.sparkSession)
    by_band: dict[int, list[int]] = {}
    for r in known.select("band", "key").distinct().collect():
        by_band.setdefault(r.band, []).append(r.key)

    # no filter on the words: it would be pushed down and cut every text twice
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    hashed = texts.select("doc_id", "words", run_hashes(F.col("words")).alias("runs"))
    windows = hashed.select("doc_id", "words", "runs", F.explode(
        F.sequence(F.lit(0), F.greatest(F.size("runs") - 1, F.lit(0)), F.lit(STRIDE))).alias("at"))
    left = F.greatest(F.col("at") - longest - ROOM, F.lit(0))
    own = bands(F.col("runs"), F.col("at"))
    some = F.lit(False)
    for i, band in enumerate(own):
        some = some | band.isin(by_band.get(i, []))
    near = windows.where(some).select(
        "doc_id", "at", left.alias("left"), F.array(*own).alias("keys"),
        F.slice("words", left + 1, F.col("at") - left + WINDOW + longest + ROOM).alias("near"))
    found = (near.select("*", F.posexplode("keys").alias("band", "key")).join(F.broadcast(known), ["band", "key"])
             .where(~F.arrays_overlap(F.slice("keys", F.lit(1), F.col("band")), "notice_keys")))  # the first band they share
    # only the words that a copy around this window can reach
    begin = F.greatest(F.col("at") - F.col("left") - F.size("template") - ROOM, F.lit(0))
    reach = F.slice("near", begin + 1, F.col("at") - F.col("left") - begin + WINDOW + F.size("template") + ROOM)

    def runs(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1),
                           lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))

    place = found.select("doc_id", "license", "template", (F.col("left") + begin).alias("begin"), reach.alias("reach"))
    place = place.select("doc_id", "license", "begin", F.array_distinct(runs(F.col("template"))).alias("want"),
                         runs(F.col("reach")).alias("have"))
    shared = F.array_intersect("want", "have")
    first = F.col("begin") + F.array_min(F.transform("shared", lambda s: F.array_position("have", s))) - 1
    scored = place.withColumn("shared", shared).select(
        "doc_id", "license", (F.size("shared") / F.size("want")).alias("containment"), first.cast("bigint").alias("first"))
    return (scored.where(F.col("containment") >= containment)
            .groupBy("doc_id", "license")
            .agg(F.max(F.struct("containment", (-F.col("first")).alias("f"))).alias("m"))
            .select("doc_id", "license", "m.containment", (-F.col("m.f")).alias("first_word")))
