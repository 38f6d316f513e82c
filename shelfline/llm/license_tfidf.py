"""License scans by sparse TF-IDF cosine and directory inheritance [native].

Header lines (lines with a licensing word) and licence files are sparse
TF-IDF vectors; each is compared with templates by a join on terms, summing
products for each (line, template).  Equal lines are one line: a notice that a
third of all files carry is scored once.  A header line is scored alone and with
the lines around it (long notices are wrapped); an SPDX line states the first
identifier it names, and nothing if that is unknown.  A licence file is compared
as a whole with full licence texts (``licences/``), which go first, then as a
whole and line by line with the notices.  A file whose own lines reach no
template inherits the licence of the nearest ancestor directory that has a
licence file: the distinct directories are joined with the licence files'
directories over their ancestors, and files take the result of their
directory.

Defined cases: a null text has no lines, a null path is the root directory's
unnamed file; files without header lines and without a licensed ancestor get a
null licence and score 0; ties of score go to the template first in sort order,
ties of licence files in one directory to the best score, then the licence first
in order; an empty table gives an empty result; repeated rows each get a row; a text
of any length is read whole, line by line; only ``path`` and ``text`` are read.
"""

from __future__ import annotations

import math
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch, documents

#: Notices by which the licences are stated.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This source code form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: SPDX identifiers of the licences; ``-only``, ``-or-later`` and ``+`` are cut off.
SPDX_IDS = ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0",
            "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0",
            "Unlicense")
SPDX = r"(?i)SPDX-License-Identifier:[\s(]*([A-Za-z0-9.+-]+)"
_GNU = ("{0} is free software{3} you can redistribute it and/or modify it under the terms of the GNU {1}General Public "
        "License as published by the Free Software Foundation{4} either version {2} of the License, or (at your option) "
        "any later version.")
#: Standard long headers.
TEMPLATES += (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("AGPL-3.0", _GNU.format("This program", "Affero ", "3", ":", ",")),
    ("GPL-2.0", _GNU.format("This program", "", "2", ";", ";")),
    ("GPL-3.0", _GNU.format("This program", "", "3", ":", ",")),
    ("LGPL-2.1", _GNU.format("This library", "Lesser ", "2.1", ";", ";")),
    ("LGPL-2.1", _GNU.format("This program", "Lesser ", "2.1", ";", ";")),
    ("LGPL-3.0", _GNU.format("This program", "Lesser ", "3", ":", ",")),
    ("LGPL-3.0", _GNU.format("This library", "Lesser ", "3", ":", ",")),
)
#: Licences that let a document be used for training.
OPEN = ("0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC0-1.0", "ISC", "MIT", "Unlicense")
MIN_COSINE = 0.6
#: Weight of a term that every template has: notices are short and need such
#: terms, in full texts they are words like "the" and "software".
SMOOTH, SMOOTH_FULL = 1.0, 0.05
#: Lines before and behind a header line that a wrapped notice may take.
BEFORE, BEHIND = 2, 4
#: A line with one of these words is a header line.
HEADER = r"(?i)\b(licen[cs]\w*|unlicen[cs]\w*|copyright|spdx|cc0|public domain)\b"
#: Files with such a name, and no others, state the licence of their directory: a
#: notice in any other file speaks for that file alone.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicen[cs]e)([._-][^/]*)?$"
#: A document's source that names a licence file in a directory.  A bare name is a label
#: like any other source: as a file it would license every document.
SOURCE_FILE = r"[^/]/+" + LICENCE_FILE.replace("(?i)(^|/)", "(?i)")


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _vectors(rows: DataFrame, key: str, text: str, idf: DataFrame, unseen: float) -> DataFrame:
    """(key, term, weight): tf * idf over unit length."""
    tf = (rows.select(key, F.explode(_terms(F.col(text))).alias("term"))
          .groupBy(key, "term").agg(F.count(F.lit(1)).alias("_tf"))
          .join(F.broadcast(idf), "term", "left")
          .withColumn("_w", F.col("_tf") * F.coalesce("idf", F.lit(unseen))))
    norm = tf.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    return tf.join(norm, key).select(key, "term", (F.col("_w") / F.col("_norm")).alias("weight"))


def template_model(templates: DataFrame, smooth: float = SMOOTH) -> tuple[DataFrame, DataFrame, float]:
    """Template vectors (template, license, term, weight), idf of their terms, idf
    of an unseen term.  Templates are a small table by definition."""
    templates = templates.select("license", "text", F.md5("text").alias("template"))
    n = templates.count()
    seen = templates.select("license", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    idf = seen.groupBy("term").agg((F.log((1.0 + n) / (1.0 + F.count(F.lit(1)))) + smooth).alias("idf"))
    unseen = math.log(1.0 + n) + smooth
    vectors = _vectors(templates, "template", "text", idf, unseen)
    return vectors.join(F.broadcast(templates.select("template", "license")), "template"), idf, unseen


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license string, text string")


def full_texts(spark: SparkSession) -> DataFrame:
    """Licence texts; those of two near relatives are made from them, so that
    these are not taken for one another."""
    folder = resources.files("shelfline.llm").joinpath("licences")      # also inside a zipped package
    texts = {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    texts["AGPL-3.0"] = (texts["GPL-3.0"].replace("GNU General", "GNU Affero General")
                         .replace("GNU GENERAL", "GNU AFFERO GENERAL"))
    three = texts["BSD-3-Clause"]
    texts["BSD-2-Clause"] = three[:three.index("3. ")] + three[three.index("THIS SOFTWARE"):]
    return spark.createDataFrame(sorted(texts.items()), "license string, text string")


def scored_lines(lines: DataFrame, templates: DataFrame, smooth: float = SMOOTH) -> DataFrame:
    """Best template of each distinct line: (line, license, score)."""
    vectors, idf, unseen = template_model(templates, smooth)
    distinct = lines.select("line").distinct()
    mine = _vectors(distinct, "line", "line", idf, unseen)
    theirs = vectors.select("template", "license", "term", F.col("weight").alias("_theirs"))
    cosine = (mine.join(F.broadcast(theirs), "term").groupBy("line", "template", "license")
              .agg(F.round(F.sum(F.col("weight") * F.col("_theirs")), 9).alias("score")))
    best = cosine.groupBy("line").agg(
        F.max("score").alias("score"), F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("_b"))
    return best.where(F.col("score") >= MIN_COSINE).select("line", F.col("_b.license").alias("license"), "score")


def spdx_lines(lines: DataFrame) -> DataFrame:
    """(line, license, score) of the lines with a known SPDX identifier."""
    short = F.regexp_replace(F.lower(F.regexp_extract("line", SPDX, 1)), r"(-only|-or-later|\+)$", "")
    named = F.create_map(*[F.lit(x) for name in SPDX_IDS for x in (name.lower(), name)])
    return (lines.select("line").distinct().select("line", F.try_element_at(named, short).alias("license"))
            .where("license is not null").select("line", "license", F.lit(1.0).alias("score")))


def _parent(path: Column) -> Column:
    """The directory of a path ("" is the root)."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(dirs: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, license, score) of the nearest ancestor, itself included.
    ``licensed``: (dir, license, score), one row a directory."""
    parts = F.split(F.col("dir"), "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    ancestors = (dirs.select("dir", parts.alias("_parts"), F.explode(F.sequence(F.lit(0), depth)).alias("_depth"))
                 .select("dir", "_depth", F.array_join(F.slice("_parts", F.lit(1), F.col("_depth")), "/").alias("_up")))
    up = licensed.select(F.col("dir").alias("_up"), "license", "score")
    return (ancestors.join(up, "_up").groupBy("dir")
            .agg(F.max(F.struct("_depth", "license", "score")).alias("_n"))
            .select("dir", F.col("_n.license").alias("license"), F.col("_n.score").alias("score")))


def license_scan(files: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """``files`` (path, text and others) with license, score and ``via``:
    ``header``, ``inherited`` or null."""
    spark = files.sparkSession
    scratch = Scratch(spark, "license-scan")
    templates = default_templates(spark) if templates is None else templates
    named = F.coalesce(F.col("path"), F.lit(""))
    is_file = named.rlike(LICENCE_FILE)
    text = F.coalesce(F.col("text"), F.lit(""))
    has_header = text.rlike(HEADER) | is_file
    rows = (files.where(has_header).select(named.alias("_path"), is_file.alias("_file"), F.xxhash64("text").alias("_text"),
                                           text.alias("_whole"), F.split(text, "\n").alias("_lines"))
            .withColumn("_at", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1),
                                        lambda i: F.get("_lines", i).rlike(HEADER) & ~F.get("_lines", i).rlike(SPDX))))
    around = F.transform("_at", lambda i: F.array_join(F.slice(
        "_lines", F.greatest(i - BEFORE, F.lit(0)) + 1, F.least(i, F.lit(BEFORE)) + 1 + BEHIND), " "))
    # kind 0: a whole licence file; 1: a line; 2: a header line and those around it
    def pieces(kind, lines):
        return F.transform(lines, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("line")))
    every = F.concat(pieces(1, F.col("_lines")), pieces(2, around),
                     pieces(0, F.when(F.col("_file"), F.array("_whole")).otherwise(F.array().cast("array<string>"))))
    lines = (rows.select("_path", "_file", "_text", F.explode(every).alias("_p"))
             .select("_path", "_file", "_text", "_p.kind", "_p.line").where(F.col("line").rlike(r"\S"))
             .withColumn("_header", F.col("line").rlike(HEADER) | (F.col("kind") == 0)))
    lines = scratch.write(lines.groupBy("_path", "_text", "_file", "kind", "line", "_header").count(), "lines")
    spdx = (F.col("kind") == 1) & F.col("line").rlike(SPDX)
    heads = lines.where("_header")
    notices = scored_lines(heads.where(~spdx), templates).withColumn("_rank", F.lit(1))
    stated = spdx_lines(heads.where(spdx)).withColumn("_rank", F.lit(1))
    whole = scored_lines(heads.where("kind = 0"), full_texts(spark), SMOOTH_FULL).withColumn("_rank", F.lit(0))
    scored = (notices.withColumn("_full", F.lit(False)).unionByName(stated.withColumn("_full", F.lit(False)))
              .unionByName(whole.withColumn("_full", F.lit(True))))
    judged = lines.join(scored.withColumnRenamed("line", "_scored"), (F.col("line") == F.col("_scored"))
                        & (~F.col("_full") | (F.col("kind") == 0)), "left")
    own = (judged.groupBy("_path", "_text").agg(
        F.min(F.when(F.col("score").isNotNull(), F.struct("_rank", (-F.col("score")).alias("s"), "license"))).alias("_best"),
        F.max("_file").alias("_states")).withColumn("score", -F.col("_best.s")))
    own = scratch.write(own.where(F.col("score").isNotNull()).select(
        "_path", "_text", F.col("_best.license").alias("license"), "score", "_states"), "own")
    licensed = (own.where("_states").select(_parent(F.col("_path")).alias("dir"), "license", "score")
                .groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("_b"))
                .select("dir", F.col("_b.license").alias("license"), (-F.col("_b.s")).alias("score")))
    keyed = files.select(*[F.col(f"`{c}`") for c in files.columns if c not in ("license", "score", "via")],
                         named.alias("_ls_path"), F.xxhash64("text").alias("_ls_text"),
                         _parent(named).alias("_ls_dir"))
    dirs = files.select(_parent(named).alias("dir")).distinct()
    from_dir = inherited(dirs, licensed).select(
        F.col("dir").alias("_ls_up"), F.col("license").alias("_ls_license"), F.col("score").alias("_ls_score"))
    mine = own.select(F.col("_path").alias("_ls_path"), F.col("_text").alias("_ls_text"), "license", "score")
    out = (keyed.join(mine, ["_ls_path", "_ls_text"], "left")
           .join(from_dir, F.col("_ls_dir") == F.col("_ls_up"), "left"))
    return (out.withColumn("via", F.when(F.col("license").isNotNull(), "header")
                           .when(F.col("_ls_license").isNotNull(), "inherited"))
            .withColumn("license", F.coalesce("license", "_ls_license"))
            .withColumn("score", F.coalesce("score", "_ls_score", F.lit(0.0)))
            .drop("_ls_path", "_ls_text", "_ls_dir", "_ls_up", "_ls_license", "_ls_score"))


def op3_license_tfidf(spark, sf_dir):
    """Documents as files ``source/lang/doc_id``; where the source names a licence file
    (``repo/LICENSE``) the document is that file."""
    none = F.lit("")
    below = F.concat_ws("/", F.coalesce("source", none), F.coalesce("lang", none),
                        F.coalesce(F.col("doc_id").cast("string"), none))
    docs = documents(spark, sf_dir).select(
        "doc_id", F.when(F.col("source").rlike(SOURCE_FILE), F.col("source")).otherwise(below).alias("path"), "text")
    out = license_scan(docs)
    return out.select("doc_id", "path", "license", "score", "via",
                      F.coalesce(F.col("license").isin(*OPEN), F.lit(False)).alias("open"))
