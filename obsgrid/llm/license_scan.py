"""License scan: MinHash bands of overlapping windows, then exact containment.

A text is its lower-cased words (runs of letters and digits) and their
five-word shingles, hashed to longs. Overlapping windows of ``window``
consecutive shingles, one from each shingle on, get one MinHash value for each
of ``bands`` seeds: the smallest hash after an exclusive or with the seed. A
band is one value. The templates' windows give the band index; a text window
that shares a band retrieves the template. A retrieved template matches if the
document holds at least ``containment`` of its distinct shingles, counted
exactly, and for each deciding phrase of its license that stands in the
template a shingle with the whole phrase. Deciding are the family words and
version numbers that alone tell a notice from its neighbours.

Probability of retrieval: where ``window`` neighbouring shingles of a template
stand in the text unchanged, both sides have the same window and every band
collides. A template of two or more shingles that is contained to 0.8 always
leaves two neighbours, so none is missed.

A template of three to five words is one shingle of its whole length and has
no window to compare. Texts are hashed in that length too, and the shingle's
hash is its index, without a band.

Templates are a parameter of bounded size (``MAX_TEMPLATES``), so their index
goes with the plan. Documents are never shuffled or grouped. Everything is
DataFrame operations.

Defined results: one row for each document row and matching template. NULL and
empty texts and texts shorter than a template's shingles don't match it; a
template must have three words. Rows that repeat a document each match for themselves. An empty
table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.llm.common import fresh

SHINGLE = 5
#: lengths of templates that are one shingle of their own
SHORT = (3, 4)
WINDOW = 2
CONTAINMENT = 0.8
MAX_TEMPLATES = 1000
#: one seed for each band, digits of pi
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89,
         0x452821E638D01377, 0xBE5466CF34E90C6C, 0xC0AC29B7C97C50DD, 0x3F84D5B5B5470917)
WORD_BREAK = r"[^\p{L}\p{N}]+"

# Notices as the licenses' own texts give them, by their usual short names.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    # those of neighbours begin late enough to stay under the containment in each other's notices
    "GPL-2.0": [
        "GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of "
        "the License",
    ],
    "LGPL-2.0": [
        "GNU Library General Public License",
    ],
    "LGPL-2.1": [
        "GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License",
    ],
    "LGPL-3.0": [
        "GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
    ],
    "AGPL-3.0": [
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    # the preamble is that of the whole family
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ],
    # the second condition, followed by the disclaimer
    "BSD-2-Clause": [
        "in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT "
        "HOLDERS AND CONTRIBUTORS",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}

# Words that tell a license from its neighbours, as words() gives them.
DECIDING = {
    "GPL-3.0": ["gnu general", "version 3"],
    "GPL-2.0": ["gnu general", "version 2"],
    "LGPL-2.0": ["gnu library"],
    "LGPL-2.1": ["gnu lesser", "version 2 1"],
    "LGPL-3.0": ["gnu lesser", "version 3"],
    "AGPL-3.0": ["gnu affero"],
    "Apache-2.0": ["apache", "2 0"],
    "MPL-2.0": ["mozilla", "2 0"],
    "BSD-2-Clause": ["distribution this software"],
    "BSD-3-Clause": ["neither the name"],
}

#: notices shorter than a shingle
NOTICES = {"All-rights-reserved": ["All rights reserved."]}


def _signed(seed: int) -> int:
    return seed - (1 << 64) if seed >> 63 else seed


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def shingle_hashes(words_: Column, size: int = SHINGLE) -> Column:
    """Hashes of the shingles of ``size`` words of a word array; empty if it has fewer."""
    n = F.size(words_) - size
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(*[F.get(words_, i + k) for k in range(size)]))
                  ).otherwise(F.array().cast("array<long>"))


def band_values(shingles: Column, seed: int, window: int = WINDOW) -> Column:
    """The MinHash value of every window for one seed; a window at the end may be shorter."""
    def smallest(i: Column) -> Column:
        return F.least(*[F.get(shingles, i + k).bitwiseXOR(F.lit(_signed(seed)).cast("long")) for k in range(window)],
                       F.lit((1 << 63) - 1))

    return F.when(F.size(shingles) > 0, F.transform(F.sequence(F.lit(0), F.size(shingles) - 1), smallest)
                  ).otherwise(F.array().cast("array<long>"))


def _fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator, so that their users read them and don't work them out again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def template_table(spark, templates: dict[str, list[str]]) -> DataFrame:
    """Rows (license, template, words, size, placed, shingles): numbers are places in the license's list, size is a shingle's
    words, placed are all shingles in order and shingles the distinct ones."""
    rows = [(name, i, text) for name, texts in templates.items() for i, text in enumerate(texts)]
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"license scan: {len(rows)} templates, at most {MAX_TEMPLATES} are supported")
    table = spark.createDataFrame(rows, "license string, template int, text string")
    table = table.select("license", "template", words(F.col("text")).alias("words"))
    shingles = reduce(lambda made, n: F.when(F.size("words") == n, shingle_hashes(F.col("words"), n)).otherwise(made),
                      SHORT, shingle_hashes(F.col("words")))
    return table.select("license", "template", "words", F.least(F.size("words"), F.lit(SHINGLE)).alias("size"),
                        shingles.alias("placed"), F.array_distinct(shingles).alias("shingles"))


def deciding_shingles(row, phrases: list[str]) -> list[list[int]]:
    """For each of the phrases that stands in a template's row, the template's shingles with the whole phrase."""
    out = []
    for phrase in (p.split() for p in phrases):
        whole = [s for i, s in enumerate(row["placed"])
                 if any(row["words"][j:j + len(phrase)] == phrase for j in range(i, i + row["size"] - len(phrase) + 1))]
        if whole:
            out.append(sorted(set(whole)))
    return out


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, containment: float = CONTAINMENT,
         window: int = WINDOW, bands: int = len(SEEDS), doc_id: str = "doc_id", text: str = "text",
         deciding: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows (doc_id, license, template, matched, of, first_word, last_word): templates that a document contains.

    ``matched`` of the template's ``of`` distinct shingles stand in the text,
    between its words number ``first_word`` and ``last_word`` (from 0).
    ``deciding`` has the phrases of each license; without it, ``DECIDING`` for the own templates and none for others.
    """
    spark = docs.sparkSession
    phrases = (DECIDING if templates is None else {}) if deciding is None else deciding
    known = template_table(spark, TEMPLATES | NOTICES if templates is None else templates).collect()     # at most MAX_TEMPLATES
    if any(not r["shingles"] for r in known):
        raise ValueError("license scan: a template needs three words or more")
    sizes = sorted({r["size"] for r in known})
    index = [[set() for _ in known] for _ in range(bands)]
    for t, row in enumerate(known):
        if len(row["shingles"]) == 1:
            continue
        for b in range(bands):
            own = [s ^ _signed(SEEDS[b]) for s in row["shingles"]]
            index[b][t] = {min(own[i:i + window]) for i in range(len(own))}
    longs = "array<long>"

    def literal(values) -> Column:
        # one expression: a call for each of thousands of numbers takes the driver longer than the scan
        return F.expr(f"array({', '.join(f'{v}L' for v in values)})") if values else F.array().cast(longs)

    h, hits, found = fresh("h"), fresh("hits"), fresh("found")
    hashes = {n: f"{h}_{n}" for n in sizes}
    source = docs.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("words"))
    if not known:
        return source.where("false").selectExpr("doc_id", "'' AS license", "0 AS template", "0 AS matched", "0 AS of",
                                                "0 AS first_word", "0 AS last_word")
    hashed = _fixed(source, **{c: shingle_hashes(F.col("words"), n) for n, c in hashes.items()}).drop("words")
    # one array of index keys in the text for each seed, and for each short length; all but a few rows have none
    shared = {}
    if any(len(r["shingles"]) > 1 for r in known):
        shared = {f"{hits}_{b}": F.array_intersect(band_values(F.col(hashes[SHINGLE]), SEEDS[b], window),
                                                   literal(sorted(set().union(*index[b])))) for b in range(bands)}
    for n in sizes:
        own = sorted({r["shingles"][0] for r in known if r["size"] == n and len(r["shingles"]) == 1})
        if own:
            shared[f"{hits}_of_{n}"] = F.array_intersect(F.col(hashes[n]), literal(own))

    def either(columns) -> Column:
        return reduce(lambda x, y: x | y, columns)

    def decided(row) -> Column:
        own = deciding_shingles(row, phrases.get(row["license"], []))
        return F.array(*[literal(s) for s in own]).cast("array<array<long>>")

    def meets(t: int, row) -> Column:
        if len(row["shingles"]) == 1:
            return F.array_contains(f"{hits}_of_{row['size']}", row["shingles"][0])
        return either(F.arrays_overlap(f"{hits}_{b}", literal(sorted(index[b][t]))) for b in range(bands))

    met = _fixed(hashed, **shared).where(either(F.size(c) > 0 for c in shared))
    retrieved = [F.when(meets(t, r), F.struct(F.lit(r["license"]).alias("license"), F.lit(r["template"]).alias("template"),
                                              F.lit(r["size"]).alias("size"), literal(r["shingles"]).alias("shingles"),
                                              decided(r).alias("deciding")))
                 for t, r in enumerate(known)]
    pairs = met.select("doc_id", *hashes.values(), F.explode(F.array_compact(F.array(*retrieved))).alias(found))
    # the text's shingles of the template's length
    own = F.coalesce(*[F.when(F.col(f"{found}.size") == n, F.col(c)) for n, c in hashes.items()])
    checked = _fixed(pairs.select("doc_id", own.alias(h), f"{found}.*"), **{hits: F.array_intersect(F.col("shingles"), F.col(h))})
    at = F.filter(F.transform(F.col(h), lambda x, i: F.when(F.array_contains(F.col(hits), x), i)), lambda i: i.isNotNull())
    return (checked.where(F.size(hits) >= F.lit(containment) * F.size("shingles"))
            .where(F.forall("deciding", lambda s: F.arrays_overlap(s, hits)))
            .select("doc_id", "license", "template", F.size(hits).alias("matched"), F.size("shingles").alias("of"),
                    F.array_min(at).alias("first_word"), (F.array_max(at) + F.col("size") - 1).alias("last_word")))
