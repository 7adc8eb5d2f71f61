"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

A file's header lines (lines with a licence keyword) and the file as a whole are candidates. Each
distinct candidate is a sparse vector of term counts times inverse document frequency;
its cosine to every template comes from a join on terms. A file whose whole text is near a template, or that is named like a
licence file and has a matching line, is a licence file: it licenses its directory. A
file without a match of its own takes the licence of its nearest ancestor directory that has one.

Document frequencies count all header lines of all files and the templates once each.

* null or empty text: no candidate; the file can still inherit
* null path: the file keeps its own match and inherits nothing
* ties: the higher score, then the smaller licence name; a whole-file match goes before a header
* repeated rows: one result row for each; empty table: empty result; other columns are ignored

DataFrame expressions only. Candidates are made distinct before they become terms, and
directories before they become ancestors; each joins back once. Every term row meets at most as
many template rows as there are templates, a fixed number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.sources.staging import stage

#: SPDX identifiers by licence, plain notices with each year, whole texts, and usual short statements of licences.
SPDX = (
    ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"), ("ISC", "ISC"),
    ("GPL-2.0", "GPL-2.0"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"), ("GPL-2.0", "GPL-2.0+"),
    ("GPL-3.0", "GPL-3.0"), ("GPL-3.0", "GPL-3.0-only"), ("GPL-3.0", "GPL-3.0-or-later"), ("GPL-3.0", "GPL-3.0+"),
    ("LGPL-2.1", "LGPL-2.1"), ("LGPL-2.1", "LGPL-2.1-only"), ("LGPL-2.1", "LGPL-2.1-or-later"),
    ("LGPL-3.0", "LGPL-3.0"), ("LGPL-3.0", "LGPL-3.0-only"), ("LGPL-3.0", "LGPL-3.0-or-later"),
    ("AGPL-3.0", "AGPL-3.0"), ("AGPL-3.0", "AGPL-3.0-only"), ("AGPL-3.0", "AGPL-3.0-or-later"),
    ("MPL-2.0", "MPL-2.0"), ("EPL-1.0", "EPL-1.0"), ("EPL-2.0", "EPL-2.0"), ("CDDL-1.0", "CDDL-1.0"), ("BSL-1.0", "BSL-1.0"), ("Zlib", "Zlib"),
    ("CC-BY-4.0", "CC-BY-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), ("CC0-1.0", "CC0-1.0"),
    ("Unlicense", "Unlicense"), ("WTFPL", "WTFPL"), ("0BSD", "0BSD"), ("Apache-2.0 OR MIT", "Apache-2.0 OR MIT"),
)
YEARS = range(1990, 2031)
_PERMIT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = (
    *((name, f"SPDX-License-Identifier: {spdx}") for name, spdx in SPDX),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved."),
    *(("Proprietary", f"Copyright {year} All rights reserved.") for year in YEARS),
    *(("Proprietary", f"Copyright (c) {year} Inc. All rights reserved.") for year in YEARS),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
     'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
     "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
     "IN THE SOFTWARE."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission. " + _BSD_END),
    ("ISC", _PERMIT + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", _PERMIT + "."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE file in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3"),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved. Confidential and proprietary. Unauthorized copying is prohibited."),
)
KEYWORDS = r"(?i)licen[sc]|copyright|spdx-|redistribut|permission is hereby|public domain|all rights reserved"
LICENSE_NAME = r"(?i)^(licen[sc]e|copying|notice|unlicense)([.\-_].*)?$"
TERM = r"[a-z0-9]+"
MIN_HEADER = 0.6
MIN_FILE = 0.8


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def template_table(spark: SparkSession) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(n).alias("license"), F.lit(t).alias("text")) for i, (n, t) in enumerate(TEMPLATES)))
    return spark.range(1).select(F.inline(rows))


def _weights(texts: DataFrame, key: str, idf: DataFrame, rarest: Column) -> DataFrame:
    """(key, term, weight of unit length); a term without a frequency weighs as one never seen."""
    counts = texts.select(key, F.explode(_terms(F.col("text"))).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    counts = stage(counts, "terms")  # read for the weights and for their norms
    weighed = counts.join(idf, counts["term"] == idf["term_"], "left").select(
        key, "term", (F.col("tf") * F.coalesce("idf", rarest)).alias("w")
    )
    norms = weighed.groupBy(F.col(key).alias("key_")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norms, F.col(key) == F.col("key_")).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def scored_texts(texts: DataFrame, templates: DataFrame, counted: DataFrame) -> DataFrame:
    """(digest, license, score): the best template for each distinct text (digest, text).

    ``counted`` has the header lines (text, n) whose terms make the document frequencies.
    """
    everything = counted.select("text", "n").unionByName(templates.select("text", F.lit(1).cast("long").alias("n")))
    total = everything.agg(F.sum("n")).first()[0]
    rarest = F.log(F.lit(1.0 + total)) + 1
    seen = everything.select("n", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term_"))
    idf = (
        seen.groupBy("term_")
        .agg(F.sum("n").alias("df"))
        .select("term_", (F.log(F.lit(1.0 + total) / (1 + F.col("df"))) + 1).alias("idf"))
    )
    idf = stage(idf, "idf")
    ours = _weights(texts, "digest", idf, rarest)
    theirs = _weights(templates, "template", idf, rarest).select("template", F.col("term").alias("term__"), F.col("w").alias("v"))
    dots = (
        ours.join(theirs, F.col("term") == F.col("term__"))
        .groupBy("digest", "template")
        .agg(F.sum(F.col("w") * F.col("v")).alias("score"))
        .join(templates.select(F.col("template").alias("template_"), "license"), F.col("template") == F.col("template_"))
        .groupBy("digest", "license")
        .agg(F.round(F.max("score"), 6).alias("score"))
    )
    best = F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), F.col("license")))
    return dots.groupBy("digest").agg(best.alias("best")).select("digest", "best.license", "best.score")


def scan_licenses(
    files: DataFrame, id_col: str, path: Column, text_col: str = "text", templates: DataFrame | None = None
) -> DataFrame:
    """For every file: id, path, license, score, found_in (file, header, inherited or null), licensed_by (directory of an inherited one)."""
    spark = files.sparkSession
    templates = templates if templates is not None else template_table(spark)
    text = F.col(text_col).cast("string")
    known = files.select(F.col(id_col).alias("id"), path.cast("string").alias("path"), text.alias("text"))
    plain = known.withColumn("row", F.xxhash64("id", "path", "text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(KEYWORDS))
    hit = plain.where(F.col("text").rlike(KEYWORDS))
    whole = hit.select("row", "id", "path", F.lit("file").alias("kind"), F.sha2("text", 256).alias("digest"), "text")
    heads = hit.select("row", "id", "path", F.lit("header").alias("kind"), F.explode(lines).alias("text"))
    heads = heads.withColumn("digest", F.sha2("text", 256)).select(whole.columns)
    candidates = stage(whole.unionByName(heads), "candidates")
    counted = candidates.where("kind = 'header'").groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("text"))
    distinct = candidates.groupBy("digest").agg(F.min("text").alias("text"))
    scores = scored_texts(stage(distinct, "texts"), templates, stage(counted, "lines")).withColumnRenamed("digest", "digest_")
    name, folder = F.substring_index("path", "/", -1), F.regexp_replace("path", "/?[^/]*$", "")
    enough = F.when(F.col("kind") == "file", F.col("score") >= MIN_FILE).otherwise(F.col("score") >= MIN_HEADER)
    matched = candidates.join(scores, F.col("digest") == F.col("digest_")).where(enough)
    rank = F.struct((F.col("kind") != "file").alias("later"), (-F.col("score")).alias("loss"), F.col("license").alias("name"))
    own = matched.groupBy("row", "id", "path").agg(F.min_by(F.struct("license", "score", "kind"), rank).alias("own"))
    own = stage(own.select("row", "id", "path", "own.*"), "own")
    licensing = own.where((F.col("kind") == "file") | name.rlike(LICENSE_NAME)).where("path is not null").withColumn("dir", folder)
    ruled = licensing.groupBy("dir").agg(F.min_by("license", F.struct(-F.col("score"), F.col("license"))).alias("inherited"))
    depth = F.size(F.split("folder", "/"))
    ancestors = F.concat(
        F.transform(F.sequence(F.lit(1), depth), lambda i: F.struct(F.array_join(F.slice(F.split("folder", "/"), 1, i), "/").alias("dir"), i.alias("depth"))),
        F.array(F.struct(F.lit("").alias("dir"), F.lit(0).alias("depth"))),
    )
    folders = plain.where("path is not null").select(folder.alias("folder")).distinct()
    nearest = (
        folders.select("folder", F.inline(ancestors))
        .join(ruled.withColumnRenamed("dir", "dir_"), F.col("dir") == F.col("dir_"))
        .groupBy(F.col("folder").alias("folder_"))
        .agg(F.max_by(F.struct("inherited", "dir"), "depth").alias("near"))
    )
    own = own.select(F.col("row").alias("row_"), F.col("id").alias("id_"), F.col("path").alias("path_"), "license", "score", "kind").distinct()
    same = (F.col("row") == F.col("row_")) & F.col("id").eqNullSafe(F.col("id_")) & F.col("path").eqNullSafe(F.col("path_"))
    result = plain.drop("text").withColumn("folder", folder).join(own, same, "left").join(nearest, F.col("folder") == F.col("folder_"), "left")
    missing = F.col("license").isNull()
    return result.select(
        "id",
        "path",
        F.coalesce("license", "near.inherited").alias("license"),
        "score",
        F.when(~missing, F.col("kind")).when(F.col("near").isNotNull(), F.lit("inherited")).alias("found_in"),
        F.when(missing, F.col("near.dir")).alias("licensed_by"),
    )
