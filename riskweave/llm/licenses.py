"""License scan: TF-IDF cosine to templates, and inheritance from the nearest directory.

Every line of a text is a possible header. Terms are runs of letters and digits
in lower case; a template's term has its inverse document frequency over all
documents, any other term the highest of those. A line's license is the
template of the largest cosine, if that reaches ``least``. A line can only
reach it if it shares one of a template's anchors: its heaviest terms, as many
as it takes until the rest of the template's vector is too short for ``least``.
So lines without an anchor are left out without loss.

A file whose whole text reaches ``least_file`` is a license file and speaks for
its directory. A file without a license of its own takes that of the nearest
directory above it: the distinct directories are joined with the license files'
directories by path. DataFrame functions only.

Edge cases: rows that share id and path are one file; null and empty texts have no header; a null path has no directory
and inherits nothing; ties of templates go to the first name, of license files
in a directory to the larger cosine, then the first path; an empty table gives
no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import staged

#: Short notices of licenses, as projects put them into files (fixed values).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
SPLIT = "[^a-z0-9]+"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda t: t != "")


def template_terms(templates) -> dict[str, dict[str, int]]:
    import re
    out = {}
    for name, text in templates:
        words = [w for w in re.split(SPLIT, text.lower()) if w]
        out[name] = {w: words.count(w) for w in words}
    return out


def weights(files: DataFrame, templates) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' terms over all files, and of any other term."""
    vocabulary = sorted({w for t in template_terms(templates).values() for w in t})
    held = F.array_intersect(F.array_distinct(terms(F.col("text"))), F.array(*map(F.lit, vocabulary)))
    n = files.count()
    found = {r["term"]: r["n"] for r in files.select(F.explode(held).alias("term")).groupBy("term")
             .agg(F.count("*").alias("n")).collect()}  # as many rows as the templates have terms
    idf = {w: math.log((1 + n) / (1 + found.get(w, 0))) + 1 for w in vocabulary}
    return idf, max(idf.values())


def anchors(idf: dict[str, float], templates, least: float) -> list[str]:
    """Per template its heaviest terms, until the rest is shorter than ``least`` of the whole."""
    out = set()
    for held in template_terms(templates).values():
        square = {w: (n * idf[w]) ** 2 for w, n in held.items()}
        rest = total = sum(square.values())
        for w in sorted(square, key=lambda w: (-square[w], w)):
            if rest < (0.999 * least) ** 2 * total:
                break
            out.add(w)
            rest -= square[w]
    return sorted(out)


def scan(files: DataFrame, templates=TEMPLATES, least: float = 0.6, least_file: float = 0.8) -> DataFrame:
    """id, path, license, found (header, file, inherited or null) and from_dir of every file.

    ``files``: id, path, text. A path's directory is what stands before its last slash.
    """
    spark = files.sparkSession
    files = files.select("id", "path", F.coalesce("text", F.lit("")).alias("text"))
    idf, other = weights(files, templates)
    marks = anchors(idf, templates, least)
    held = template_terms(templates)
    length = {name: math.sqrt(sum((n * idf[w]) ** 2 for w, n in t.items())) for name, t in held.items()}
    table = F.broadcast(spark.createDataFrame(  # as many rows as the templates have terms
        [(w, name, n * idf[w] / length[name]) for name, t in held.items() for w, n in t.items()],
        "term string, license string, share double"))
    known = F.create_map(*(F.lit(x) for w in sorted(idf) for x in (w, idf[w])))
    has_mark = lambda c: F.arrays_overlap(terms(c), F.array(*map(F.lit, marks)))
    marked = files.select("id", "path", "text").filter(F.lower("text").rlike("|".join(marks)))
    lines = marked.select("id", "path", F.posexplode(F.split("text", "\n")).alias("line", "words")).filter(has_mark(F.col("words")))
    units = lines.unionByName(marked.filter(has_mark(F.col("text"))).select("id", "path", F.lit(-1).alias("line"),
                                                                            F.col("text").alias("words")))
    units = units.select("id", "path", "line", terms(F.col("words")).alias("words")).withColumn("unit", F.monotonically_increasing_id())
    # The vector of a unit is summed up in its own row: tf by term, then length; only template terms are joined.
    counted = staged(units.select("id", "path", "line", "unit", F.explode("words").alias("term")).groupBy(
        "id", "path", "line", "unit", "term").agg(F.count("*").alias("n")), "license-units")
    weighed = counted.withColumn("w", F.col("n") * F.coalesce(known[F.col("term")], F.lit(other)))
    norms = weighed.groupBy("id", "path", "line", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(table, "term").groupBy("id", "path", "line", "unit", "license").agg(F.sum(F.col("w") * F.col("share")).alias("dot"))
    scored = (dots.join(norms.select("unit", "norm"), "unit").withColumn("cosine", F.col("dot") / F.col("norm"))
              .filter(F.col("cosine") >= F.when(F.col("line") < 0, least_file).otherwise(least)))
    ranks = F.create_map(*(F.lit(x) for k, name in enumerate(sorted(held)) for x in (name, -k)))
    choice = F.struct(F.round("cosine", 9).alias("cosine"), ranks[F.col("license")].alias("order"), "license")
    own = scored.groupBy("id", "path").agg(
        F.max(F.when(F.col("line") >= 0, choice)).alias("header"), F.max(F.when(F.col("line") < 0, choice)).alias("file"))
    directory = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    speaks = own.filter("file is not null").withColumn("dir", directory).groupBy("dir").agg(
        F.max_by("file.license", F.struct("file.cosine", "file.order")).alias("license"))
    dirs = files.select(directory.alias("dir")).filter("path is not null").distinct()
    # Every directory with itself and all above it: "a/b/c" gives "a/b/c", "a/b", "a", "".
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)),
                                                     lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("up")).distinct()
    inherited = (above.join(speaks.withColumnRenamed("dir", "up"), "up").groupBy("dir")
                 .agg(F.max_by(F.struct("license", "up"), F.length("up")).alias("from")))
    out = (files.select("id", "path", directory.alias("dir"))
           .join(own.withColumnRenamed("id", "own_id").withColumnRenamed("path", "own_path"),
                 F.col("id").eqNullSafe(F.col("own_id")) & F.col("path").eqNullSafe(F.col("own_path")), "left")
           .join(inherited, "dir", "left"))
    has_path = F.col("path").isNotNull()
    return out.select(
        "id", "path", F.coalesce("file.license", "header.license", F.when(has_path, F.col("from.license"))).alias("license"),
        F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header")
        .when(has_path & F.col("from").isNotNull(), "inherited").alias("found"),
        F.when(F.col("file").isNull() & F.col("header").isNull() & has_path, F.col("from.up")).alias("from_dir"))
