"""Licence scans, native: sparse TF-IDF cosine of notices to templates, then inheritance.

Notices are the lines of a file that speak of licences or copyright, or that meet the threshold with
a template, wherever they stand. Terms are weighed by the lines that speak of licences.
A file mostly made of notices is a licence file of its directory. A file without a notice of
its own inherits from its nearest ancestor directory, by equi-joins on directory paths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.functions.arrays import bind
from shardweave.llm.joins import bounded
from shardweave.llm.rowkeys import row_key
from shardweave.staging import stage

#: The usual notices of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC0-1.0", "CC0 public domain dedication"),
    ("proprietary", "Copyright. All rights reserved"),
)
SPEAKS = r"(?i)licen[sc]e|copyright|all rights reserved|public domain|redistribution"
LEAST, FILE_SHARE = 0.45, 0.5
#: Numbers of common terms that tell words apart by their least weight; they only save work.
COMMON = (16, 128, 1024)


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda w: w != "")


def _may_meet(text: Column, shares: list, common: list) -> Column:
    """Whether a line can reach ``LEAST``: exact for a no.

    ``shares`` are rows (term, body, idf, share): what one occurrence of a template's term adds to the dot product
    with that template, over its norm. So the dot products are exact, those of all templates at once are
    bounded before. The squared norm is at least that of the squared weights, over all words of the line; words
    outside the templates weigh at least 1, and more outside of the ``common`` terms: (idf, terms) says
    that all but these terms have that idf at least.
    """
    bodies = sorted({s.body for s in shares})
    idf = {s.term: s.idf for s in shares}
    share = {(s.term, s.body): s.share for s in shares}
    table = F.map_from_arrays(F.array(*map(F.lit, idf)), F.array(*[F.struct(
        F.lit(max(share.get((t, b), 0.0) for b in bodies)).alias("most"), F.lit(idf[t] ** 2 - 1).alias("more"),
        F.array(*[F.lit(share.get((t, b), 0.0)) for b in bodies]).alias("each")) for t in idf]))
    zero = F.struct(F.lit(0.0).alias("most"), F.lit(0.0).alias("more"))
    none = F.array(*[F.lit(0.0) for _ in bodies])

    def best(hits: Column) -> Column:
        return F.array_max(F.aggregate(hits, none, lambda a, t: F.zip_with(a, table[t]["each"], lambda x, y: x + y)))

    def rare(terms: Column) -> Column:
        """What words outside of the common terms add to the squared norm, beyond 1 each."""
        added, before = F.lit(0.0), 1.0
        for least, known in common:
            leave = sorted({*known, *idf})
            added = added + F.size(F.filter(terms, lambda t: ~t.isin(leave))) * F.lit(least ** 2 - before)
            before = least ** 2
        return added

    def least(squares: Column) -> Column:
        return (LEAST - 1e-5) * F.sqrt(squares)

    return bind(_terms(text), lambda terms: bind(
        F.filter(terms, lambda t: t.isin(list(idf))), lambda hits: (F.size(hits) > 0) & bind(
            F.aggregate(F.transform(hits, lambda t: table[t]), zero, lambda a, x: F.struct(
                (a["most"] + x["most"]).alias("most"), (a["more"] + x["more"]).alias("more"))),
            lambda s: (s["most"] >= least(s["more"] + F.size(terms))) & bind(
                s["more"] + F.size(terms) + rare(terms),
                lambda squares: (s["most"] >= least(squares)) & (best(hits) >= least(squares))))))


def scan_licenses(files: DataFrame, path: Column, templates=TEMPLATES) -> DataFrame:
    """doc_id, path, own_license, own_score, is_license_file, license, inherited_from.

    ``own_license`` is the template with the best cosine, from ``LEAST``, of any line;
    ties go to the first name. A null path has no ancestors. Null and empty texts have no
    notices. Rows that share doc_id and text get the same result and are each returned.
    """
    spark = files.sparkSession
    rows = files.select("doc_id", path.alias("path"), row_key().alias("key"), F.col("text").cast("string").alias("text"))
    speaking = F.coalesce(F.filter(F.split("text", "\n"), lambda s: s.rlike(SPEAKS)), F.array().cast("array<string>"))
    rows = rows.withColumn("notices", F.when(F.col("text").rlike(SPEAKS), speaking).otherwise(
        F.array().cast("array<string>"))).withColumn(
        "length", F.length(F.array_join("notices", "\n"))).withColumn("of", F.length("text"))
    seen = stage(rows.filter(F.size("notices") > 0).select("key", F.explode(F.array_distinct("notices")).alias("line"))
                 .distinct(), "notices")
    # Equal lines are weighed once, with the number of files that hold them.
    weighed = stage(seen.groupBy("line").agg(F.count(F.lit(1)).alias("files")), "lines")
    total = weighed.agg(F.sum("files")).first()[0] or 0
    known = spark.createDataFrame(list(templates), "name string, body string").select(
        "name", "body", F.explode(_terms(F.col("body"))).alias("term")).groupBy("name", "body", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    df = stage(weighed.select("files", F.explode(F.array_distinct(_terms(F.col("line")))).alias("term"))
               .groupBy("term").agg(F.sum("files").alias("df")), "terms")
    idf = F.log((F.lit(total) + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    right = stage(known.join(df, "term", "left").select(
        "name", "body", "term", idf.alias("idf"), (F.col("tf") * idf).alias("v")), "templates")
    norm = right.groupBy("body").agg(F.sqrt(F.sum(F.col("v") ** 2)).alias("vn"))
    # Only lines that can reach the threshold are taken further; a row per template and term here, and the common terms.
    shares = right.join(norm, "body").select("term", "body", "idf", (F.col("idf") * F.col("v") / F.col("vn")).alias("share")).collect()
    ranked = df.orderBy(F.desc("df"), "term").limit(COMMON[-1] + 1).collect()
    common = [(math.log((total + 1) / ((ranked[n].df if n < len(ranked) else 0) + 1)) + 1, [r.term for r in ranked[:n]])
              for n in COMMON]
    silent = stage(rows.select("key", F.posexplode(F.split("text", "\n")).alias("at", "line")).filter(
        ~F.col("line").rlike(SPEAKS)).filter(_may_meet(F.col("line"), shares, common)).distinct()
        .groupBy("key", "line").agg(F.count(F.lit(1)).alias("n")), "silent")
    # Lines go by numbers from here: a row per word must not hold its whole line.
    lines = stage(weighed.select("line").filter(_may_meet(F.col("line"), shares, common)).unionByName(
        silent.select("line").distinct()).withColumn("id", F.monotonically_increasing_id()), "candidates")
    terms = lines.select("id", F.explode(_terms(F.col("line"))).alias("term"))
    left = terms.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")).join(bounded(df), "term", "left").select(
        "id", "term", (F.col("tf") * idf).alias("w"))
    line_norm = left.groupBy("id").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("wn"))
    dots = left.join(F.broadcast(right.drop("idf")), "term").groupBy("id", "name", "body").agg(
        F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = dots.join(line_norm, "id").join(F.broadcast(norm), "body").select(
        "id", "name", F.round(F.col("dot") / (F.col("wn") * F.col("vn")), 6).alias("score"))
    best = stage(lines.join(cosine.filter(F.col("score") >= LEAST).groupBy("id").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "name")).alias("b")), "id").select("line", "b"), "best")
    held = seen.select("key", "line", F.lit(0).cast("long").alias("more")).unionByName(
        silent.select("key", "line", (F.col("n") * (F.length("line") + 1)).alias("more")))
    own = stage(held.join(best, "line").groupBy("key").agg(F.min("b").alias("b"), F.sum("more").alias("more")).select(
        "key", F.col("b.name").alias("own_license"), (-F.col("b.s")).alias("own_score"), "more"), "own")
    # Notices are taken as joined by line feeds.
    length = F.col("length") + F.coalesce("more", F.lit(0)) - F.when((F.col("length") == 0) & (F.col("more") > 0), 1).otherwise(0)
    judged = stage(rows.select("doc_id", "path", "key", "length", "of").join(own, "key", "left").withColumn(
        "is_license_file", F.col("own_license").isNotNull() & (length / F.greatest("of", F.lit(1)) >= FILE_SHARE)), "judged")
    parent = F.regexp_replace("path", r"/?[^/]*$", "")
    per_dir = stage(judged.filter("is_license_file and path is not null").groupBy(parent.alias("dir")).agg(
        F.min(F.struct((-F.col("own_score")).alias("s"), F.col("own_license").alias("name"))).alias("b")).select(
        "dir", F.col("b.name").alias("dir_license")), "directories")
    parts = F.split(parent, "/")
    above = judged.filter("own_license is null and path is not null").select("path").distinct().select(
        "path", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)),
                                      lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("dir"))
    nearest = above.join(bounded(per_dir), "dir").groupBy("path").agg(
        F.max(F.struct(F.length("dir").alias("n"), "dir", "dir_license")).alias("b")).select(
        "path", F.col("b.dir").alias("_dir"), F.col("b.dir_license").alias("_license"))
    return judged.join(nearest, "path", "left").select(
        "doc_id", "path", "own_license", "own_score", "is_license_file",
        F.coalesce("own_license", "_license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("_dir")).alias("inherited_from"))
