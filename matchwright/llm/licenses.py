"""Licence scans: Dice coefficient over word bigrams against licence templates.

Every line, every paragraph and the whole of a text is compared. Texts and templates are reduced
to lower-case ASCII words. The Dice coefficient 2 |A and B| / (|A| + |B|) of two bags of bigrams
can reach t only if their sizes differ by at most the factor (2 - t) / t, so the number of words
alone rules out most templates; only for the rest are bigrams compared.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Licence texts and notices: fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
)


def normalised(text: str) -> list[str]:
    """Words of a template; the same rule as ``word_list``."""
    return re.sub(r"[^A-Za-z0-9]+", " ", text).strip(" ").lower().split(" ")


def word_list(text: Column) -> Column:
    """Lower-case ASCII words of a text; an empty array if there is none."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")), " "), lambda x: x != "")


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Least and greatest number of bigrams that can reach the threshold against ``n``."""
    sizes = [m for m in range(1, int(n * (2 - threshold) / threshold) + 2) if 2 * min(m, n) / (m + n) >= threshold]
    return min(sizes), max(sizes)


def hits(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, row, unit, unit_hash, template, license_id, dice): units that reach a template.

    A unit is a line, a paragraph (between blank lines) or the whole text; equal ones within a
    text count once. ``unit`` numbers them within the text, ``unit_hash`` is the XXH64 of the
    normalised unit, ``row`` the input row, ``template`` the template. Templates and units need
    two words or more. The templates are a parameter of the caller, small beside any table, and
    are literals of the plan.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    bags = [Counter(zip(w, w[1:], strict=False)) for w in (normalised(t) for _, t in templates)]
    known = [(i, sum(bag.values()), *size_bounds(sum(bag.values()), threshold)) for i, bag in enumerate(bags) if bag]
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    parts = F.array_distinct(
        F.concat(F.split("text", "\n"), F.split("text", r"\n[\x20\x09\x0D]*\n"), F.array("text"))
    )
    # A unit of n bigrams has at least 2n + 1 characters, so short ones are out before normalising.
    least = 2 * min((x[2] for x in known), default=0) + 1
    # The words are made inside the generator, so that later columns don't make them again.
    units = source.select(
        "doc_id",
        "row",
        F.inline(
            F.transform(
                F.filter(parts, lambda x: F.length(x) >= least),
                lambda x, i: F.struct(i.alias("unit"), word_list(x).alias("words")),
            )
        ),
    )
    sized = units.withColumn("n", F.size("words") - 1)
    fitting = F.filter(
        F.array(*[F.struct(F.lit(x[0]).alias("template"), F.lit(x[2]).alias("low"), F.lit(x[3]).alias("high")) for x in known])
        if known
        else F.array().cast("array<struct<template:int,low:int,high:int>>"),
        lambda t: F.col("n").between(t["low"], t["high"]),
    )
    open_ = (
        sized.withColumn("fitting", fitting)
        .where("size(fitting) > 0")
        .select(
            "doc_id", "row", "unit", "n", "words", F.xxhash64(F.concat_ws(" ", "words")).alias("unit_hash"),
            F.col("fitting.template").alias("fitting"),
        )
    )
    pairs = F.zip_with(
        F.slice("words", 1, F.col("n")), F.slice("words", 2, F.col("n")), lambda a, b: F.concat_ws(" ", a, b)
    )
    grams = open_.select("doc_id", "row", "unit", "unit_hash", "n", "fitting", F.explode(pairs).alias("gram"))
    rows = [(i, " ".join(g), c) for i, bag in enumerate(bags) for g, c in bag.items()]
    table = docs.sparkSession.createDataFrame(rows, "template int, gram string, times bigint")
    shared = (
        grams.join(F.broadcast(table), "gram")
        .where(F.array_contains("fitting", F.col("template")))
        .groupBy("doc_id", "row", "unit", "template", "unit_hash", "n", "gram", "times")
        .agg(F.count("*").alias("found"))
        .groupBy("doc_id", "row", "unit", "template", "unit_hash", "n")
        .agg(F.sum(F.least("found", "times")).alias("both"))
    )
    sizes = F.array(*[F.lit(sum(bag.values())) for bag in bags]) if bags else F.array().cast("array<int>")
    scored = shared.withColumn("dice", 2.0 * F.col("both") / (F.col("n") + sizes[F.col("template")]))
    names = F.array(*[F.lit(name) for name, _ in templates]) if templates else F.array().cast("array<string>")
    return scored.where(F.col("dice") >= threshold).select(
        "doc_id", "row", "unit", "unit_hash", "template", names[F.col("template")].alias("license_id"), "dice"
    )


def scan(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, license_id, dice, n_units): one row per doc_id.

    The licence of the greatest coefficient, ties to the template that stands first; n_units
    counts the different normalised lines, paragraphs and whole texts that reach some template.
    Null, empty and other texts without a hit have null, null and 0. Rows that repeat an id are
    one document of several texts, rows without id another. Other columns are ignored.
    """
    found = (
        hits(docs, **options)
        .groupBy("doc_id")
        .agg(
            F.max_by("license_id", F.struct("dice", -F.col("template"))).alias("license_id"),
            F.max("dice").alias("dice"),
            F.countDistinct("unit_hash").alias("n_units"),
        )
        .withColumnRenamed("doc_id", "found_id")
    )
    base = docs.select("doc_id").distinct()
    return base.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id", "license_id", "dice", F.coalesce("n_units", F.lit(0)).alias("n_units")
    )
