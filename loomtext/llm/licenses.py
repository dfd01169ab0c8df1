"""Operator 5: license scans by MinHash bands over overlapping windows, in DataFrame functions only.

Templates and texts are sets of five-word shingles (words are runs of letters, digits and "_", lower case). For each
size class s (a power of two, at least the template's number of shingles) a text is covered by windows of 2s shingle
positions, one every s positions, so every occurrence of a template of that class lies whole in a window. A window
that holds 80 % of a template of n shingles has a Jaccard similarity to it of at least 0.8 n / (2s + 0.2 n); the number of bands, of one
MinHash each, is such that the worst of the templates shares a band with probability RETRIEVED or more. Retrieved pairs are verified by the exact share
of the template's shingles that the window holds.

Only shingles with an anchor word take part. The anchors are chosen so that every shingle of every template has one,
which makes the restriction lossless; texts without anchors end at the first filter. The bands of the templates (fixed in number)
are the only thing broadcast. Windows, not texts, are the groups, so a long text is spread over tasks.

Defined cases: a null or empty text has no match; a template of fewer than five words is not accepted; a template that
occurs several times in a text is one row with its windows counted; repeated rows are scanned each; an empty table
gives an empty result. Other columns may have any names; they are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, table

SHINGLE = 5
CONTAINED = 0.8
#: Least probability that a window which holds a template is retrieved.
RETRIEVED = 0.9999

#: Public license notices and texts, by SPDX identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
}
_COMMON = frozenset("the of and to a in is or at be this that any are as by it on all an for with from not may you".split())


def template_words(text: str) -> list[str]:
    return re.findall(r"\w+", text.lower())


def anchor_words(templates: Mapping[str, tuple[str, ...]]) -> list[str]:
    """Words, uncommon ones where they do, of which every shingle of every template holds at least one."""
    shingles = {tuple(w[i : i + SHINGLE]) for texts in templates.values() for t in texts for w in [template_words(t)] for i in range(len(w) - SHINGLE + 1)}
    chosen: list[str] = []
    while shingles:
        counts = Counter(w for s in shingles for w in set(s))
        best = min(counts, key=lambda w: (w in _COMMON, -counts[w], w))
        chosen.append(best)
        shingles = {s for s in shingles if best not in s}
    return sorted(chosen)


def _class_of(shingles: int) -> int:
    size = 2
    while size < shingles:
        size *= 2
    return size


def _template_rows(templates: Mapping[str, tuple[str, ...]]) -> list[tuple[int, str, int, str]]:
    """(template, license, size class, words joined by blanks)"""
    rows = []
    for license, texts in sorted(templates.items()):
        for text in texts:
            words = template_words(text)
            if len(words) < SHINGLE:
                raise ValueError(f"template of fewer than {SHINGLE} words: {text!r}")
            rows.append((len(rows), license, _class_of(len(set(zip(*[words[i:] for i in range(SHINGLE)], strict=False)))), " ".join(words)))
    return rows


def _shingle_at(words: Column, i: Column) -> Column:
    return F.xxhash64(F.array_join(F.slice(words, i, F.lit(SHINGLE)), " "))


def _anchored(words: Column, anchors: Column) -> Column:
    """array<struct<position, shingle>> of the shingles that hold an anchor; positions from 0."""
    last = F.size(words) - SHINGLE
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    held = F.filter(at, lambda i: F.arrays_overlap(F.slice(words, i + 1, F.lit(SHINGLE)), anchors))
    return F.transform(held, lambda i: F.struct(i.alias("position"), _shingle_at(words, i + 1).alias("shingle")))


def least_jaccard(size: int, shingles: int) -> float:
    """The least similarity of a template to a window of its size class that holds CONTAINED of it."""
    return CONTAINED * shingles / (2 * size + (1 - CONTAINED) * shingles)


def bands_for(templates: Mapping[str, tuple[str, ...]]) -> int:
    worst = 1.0
    for _, _, size, joined in _template_rows(templates):
        words = joined.split()
        worst = min(worst, least_jaccard(size, len(set(zip(*[words[i:] for i in range(SHINGLE)], strict=False)))))
    return math.ceil(math.log(1 - RETRIEVED) / math.log(1 - worst)) if worst < 1 else 1


def _minima(bands: int) -> list[Column]:
    return [F.min(F.xxhash64(F.lit(b), "shingle")).alias(f"m{b}") for b in range(bands)]


def _bands(rows: DataFrame, bands: int, *keys: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"m{b}").alias("value")) for b in range(bands)])
    return rows.select(*keys, F.inline(each))


def scan_licenses(docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, license, template, containment, windows): one row for each row of docs and template that it holds."""
    spark = docs.sparkSession
    known, bands = _template_rows(templates), bands_for(templates)
    anchors = F.array(*[F.lit(w) for w in anchor_words(templates)])
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\W+", " ")), " ")
    classes = sorted({row[2] for row in known})

    values = ", ".join(f"({n}, '{name}', {size}, '{joined}')" for n, name, size, joined in known)
    listed = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, license, size, words)")
    own = listed.select("template", "license", "size", F.explode(_anchored(F.split("words", " "), anchors)).alias("s")).select("template", "license", "size", "s.shingle").distinct()
    own = materialise(own, "template-shingles")
    totals = own.groupBy("template").agg(F.count("*").alias("total"))
    template_bands = _bands(own.groupBy("template", "size").agg(*_minima(bands)), bands, "template", "size")

    slim = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("doc_id"), words.alias("words")).where(F.arrays_overlap("words", anchors))
    placed = slim.select("_row", "doc_id", F.explode(_anchored(F.col("words"), anchors)).alias("s")).select("_row", "doc_id", "s.position", "s.shingle")
    placed = materialise(placed, "license-shingles")
    start = lambda size: F.floor(F.col("position") / size)
    both = F.array(*[F.struct(F.lit(size).alias("size"), w.cast("long").alias("window")) for size in classes for w in (start(size), start(size) - 1)])
    windowed = placed.select("_row", "doc_id", "shingle", F.inline(both)).where("window >= 0")
    minima = windowed.groupBy("_row", "doc_id", "size", "window").agg(*_minima(bands))
    retrieved = _bands(minima, bands, "_row", "doc_id", "size", "window").join(F.broadcast(template_bands), ["size", "band", "value"]).select("_row", "doc_id", "size", "window", "template").distinct()
    wanted = retrieved.join(F.broadcast(own), ["size", "template"])
    hits = wanted.join(windowed.select("_row", "size", "window", "shingle").distinct(), ["_row", "size", "window", "shingle"])
    held = hits.groupBy("_row", "doc_id", "window", "template", "license").agg(F.count("*").alias("n")).join(F.broadcast(totals), "template")
    held = held.withColumn("containment", F.col("n") / F.col("total")).where(F.col("containment") >= CONTAINED)
    return held.groupBy("_row", "doc_id", "template", "license").agg(F.max("containment").alias("containment"), F.count("*").alias("windows")).select("doc_id", "license", "template", "containment", "windows")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license template that a document holds."""
    return scan_licenses(table(spark, sf_dir, "documents"))
