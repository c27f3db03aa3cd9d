"""License scan: MinHash bands over overlapping text windows, then exact containment.

Words are runs of a-z and 0-9 of the lower-cased text, shingles five of them. A
template of ``m`` shingles is looked for with windows of ``2 c`` shingles that start
every ``c``, where ``c`` is the least power of two not below ``m``; so every run of
``m`` shingles lies whole in some window, and the window's Jaccard similarity to a
template it contains to ``CONTAINMENT`` has a known lower bound. The number of
bands (of one MinHash row each) follows from that bound: such a window shares a
band with its template with probability ``CERTAINTY`` at least. Windows that share
a band with a template are verified by the exact share of its shingles.

Windows without a single shingle of any template can share no band, so they are
left out before hashing; that loses nothing. A template that names a version is
found only where one of the shingles that name it is there, so another version of
the same license is not taken for it. Templates are a parameter, a small table:
``TEMPLATES`` holds notices of common licenses and the texts of short ones,
``read_templates`` a folder of whole texts. Built-in functions only.

Defined cases: null, empty and short texts match nothing; templates under five
words have no shingles and match nothing; a document that holds a template several
times has one row with its best window (the earliest of equals); rows that repeat
``doc_id`` and text give one row; rows with a null ``doc_id`` are scanned as well;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import table, written

SHINGLE = 5
CONTAINMENT = 0.8
CERTAINTY = 0.999

# License notices as projects print them, and whole texts of the short licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0-notice", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or"),
    ("Apache-2.0-warranty", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-2-Clause-text", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause-text", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0-notice", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0-notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License, version 2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-notice", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or"),
    ("GPL-3.0-notice", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or"),
    ("ISC-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1-notice", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or"),
    ("LGPL-3.0-notice", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or"),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("Unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib-text", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
]
VERSION = r"\b(version|v|license|attribution|noncommercial|sharealike) \d"  # what tells versions of a license apart


def read_templates(spark: SparkSession, folder: str) -> DataFrame:
    """license_id, text of the text files of a folder, such as a collection of whole license texts."""
    files = spark.read.option("wholetext", "true").text(folder)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.txt)?$", 1)
    return files.select(name.alias("license_id"), F.col("value").alias("text"))


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " ")), " ")


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words, in order."""

    def of(w: Column) -> Column:
        starts = F.when(F.size(w) >= SHINGLE, F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, SHINGLE)))

    # the words are bound once: an expression used twice in a lambda would be computed again for each shingle
    return F.element_at(F.transform(F.array(words(text)), of), 1)


def version_shingles(text: Column) -> Column:
    """Hashes of the runs of five words that name a version."""

    def of(w: Column) -> Column:
        starts = F.when(F.size(w) >= SHINGLE, F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)))
        runs = F.filter(F.transform(starts, lambda i: F.slice(w, i, SHINGLE)), lambda r: F.rlike(F.concat_ws(" ", r), F.lit(VERSION)))
        return F.transform(runs, lambda r: F.xxhash64(r))

    return F.element_at(F.transform(F.array(words(text)), of), 1)


def bands_needed() -> int:
    """Single-row bands for a window of up to 4 m - 4 shingles that holds ``CONTAINMENT`` of m."""
    similarity = CONTAINMENT / (4 + 1 - CONTAINMENT)
    return math.ceil(math.log(1 - CERTAINTY) / math.log(1 - similarity))


def min_hashes(window: Column) -> Column:
    """The bands of a window: its least hash under each of the seeded hash functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands_needed() - 1)),
        lambda k: F.array_min(F.transform(window, lambda x: F.xxhash64(x, k))),
    )


def scan_licenses(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, license_id, containment, first_shingle (of the window) for ``docs`` (doc_id, text)
    and ``templates`` (license_id, text)."""
    known = (
        templates.select(
            "license_id",
            F.array_distinct(shingles(F.col("text"))).alias("template"),
            version_shingles(F.col("text")).alias("versions"),
        )
        .where(F.size("template") > 0)
        .withColumn("width", F.pow(F.lit(2.0), F.ceil(F.log2(F.size("template").cast("double")))).cast("int"))
    )
    known = written(known, "license-templates")
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())  # powers of two
    # a subquery, so the plan is as small for thousands of templates as for one
    anything = known.select(F.explode("template").alias("s")).agg(F.collect_set("s")).scalar()
    hits = (
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), shingles(F.col("text")).alias("h"))
        .where(F.arrays_overlap("h", anything))
        .select("doc_id", "text_key", "h", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>")).alias("width"))
    )
    starts = F.sequence(F.lit(0), F.size("h") - 1, F.col("width"))
    windows = (
        hits.select("doc_id", "text_key", "width", "h", F.explode(starts).alias("first_shingle"))
        .select(
            "doc_id", "text_key", "width", "first_shingle",
            F.slice("h", F.col("first_shingle") + 1, F.col("width") * 2).alias("window"),
        )
        .where(F.arrays_overlap("window", anything))
    )
    banded = windows.select("*", F.posexplode(min_hashes(F.col("window"))).alias("band", "least"))
    template_bands = known.select(
        "license_id", "template", "versions", F.col("width"), F.posexplode(min_hashes(F.col("template"))).alias("band", "least")
    )
    named = (F.size("versions") == 0) | F.arrays_overlap("versions", "window")
    found = banded.join(template_bands, ["width", "band", "least"]).where(named).select(
        "doc_id",
        "text_key",
        "license_id",
        "first_shingle",
        (F.size(F.array_intersect("template", "window")) / F.size("template")).alias("containment"),
    )
    best = F.struct("containment", -F.col("first_shingle"))
    return (
        found.where(F.col("containment") >= CONTAINMENT)
        .groupBy("doc_id", "text_key", "license_id")
        .agg(F.max("containment").alias("containment"), F.max_by("first_shingle", best).alias("first_shingle"))
        .drop("text_key")
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that carries a license notice."""
    templates = spark.createDataFrame(TEMPLATES, "license_id string, text string")
    return scan_licenses(table(spark, sf_dir, "documents"), templates)
