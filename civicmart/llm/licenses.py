"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Texts and templates are cut into shingles of five words. Templates are put in classes by their
number of shingles, rounded up to a power of two, L; a class reads windows of 2 L shingles every
L shingles, so any passage of up to L shingles lies whole in a window. A window holding at
least 0.8 of a template's shingles has Jaccard similarity above 0.18 with it, so with ``BANDS``
bands of one MinHash value each it collides with probability above 0.998. Colliding windows are
verified: the share of the template's shingles found in the window must be 0.8 or more.

Retrieval is by the bands alone. A band's MinHash value of a template comes from one of its
shingles, and a window of the same value holds that shingle; so the texts' shingles are joined with
the templates' band shingles, and of each window so reached the band's minimum is taken and compared.
That finds the collisions of a scan that hashes every window in every band, without hashing the
windows that cannot collide. Templates are a table of any size; the join is an ordinary one, broadcast
only by the planner's own size check. Only DataFrame functions are used.

Defined results: null and empty texts, and texts of fewer than five words, match
nothing; rows that repeat doc_id and text give one result; other columns are ignored; an
empty table gives an empty result; a template of fewer than five words is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, saved, text_key

SHINGLE = 5
BANDS = 32
#: Least share of a template's shingles, in per cent.
CONTAINED = 80

#: Short public notices, each with an identifier of its license.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)


def shingles(text: Column) -> tuple[Column, ...]:
    """Two steps to the shingle hashes of a text in order: word hashes (of ``text``), then shingles (of ``hw``)."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    hw = F.col("hw")
    grams = F.when(
        F.size(hw) >= SHINGLE,
        F.transform(
            F.slice(hw, F.lit(1), F.greatest(F.size(hw) - (SHINGLE - 1), F.lit(0))),
            lambda h, i: F.xxhash64(h, *(F.get(hw, i + k) for k in range(1, SHINGLE))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return F.transform(tokens, lambda w: F.xxhash64(w)), grams


def templates_of(spark: SparkSession, notices: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """(template, license_id, text) of a short list of notices, numbered from 0."""
    return spark.createDataFrame([(i, *n) for i, n in enumerate(notices)], "template long, license_id string, text string")


def template_table(templates: DataFrame) -> DataFrame:
    """(template, license_id, t_g, size): distinct shingles and window class of (template, license_id, text)."""
    words, grams = shingles(F.col("text"))
    made = pick(templates, "template", "license_id", "text").select("template", "license_id", words.alias("hw")).select("template", "license_id", F.array_distinct(grams).alias("t_g"))
    short = F.raise_error(F.concat(F.lit("template of fewer than five words: "), F.col("template").cast("string"))).cast("int")
    n = F.size("t_g")
    return made.withColumn("size", F.when(n == 0, short).when(n == 1, 1).otherwise(F.expr("shiftleft(1, length(bin(size(t_g) - 1)))")))


def band_shingles(templates: DataFrame) -> DataFrame:
    """(seed, template, size, values): every template's band shingles with the (band, value) of the
    bands whose MinHash they are; at most ``BANDS`` small rows for each template."""
    every = F.sequence(F.lit(0), F.lit(BANDS - 1))
    least = F.transform(every, lambda b: F.array_min(F.transform("t_g", lambda g: F.struct(F.xxhash64(g, b).alias("value"), g.alias("seed")))))
    each = templates.select("template", "size", F.posexplode_outer(least).alias("band", "m"))
    return each.groupBy(F.col("m.seed").alias("seed"), "template").agg(F.first("size").alias("size"), F.collect_list(F.struct("band", F.col("m.value").alias("value"))).alias("values"))


def collisions(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, text_key, template, size, no, g): windows that share a band's value with a template of :func:`template_table`."""
    words, grams = shingles(F.col("text"))
    cut = pick(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("text_key"), words.alias("hw")).select("doc_id", "text_key", grams.alias("grams"))
    seeds = saved(band_shingles(templates))
    size = F.col("size")
    # a shingle lies in the window that starts in its stretch of ``size`` and in the one before
    last = F.floor(F.col("pos") / size).cast("int")
    numbers = F.array_distinct(F.array(F.greatest(last - 1, F.lit(0)), last))
    reached = (
        # outer: a filter for empty arrays would be pushed below and repeat the work above
        cut.select("doc_id", "text_key", "grams", F.posexplode_outer("grams").alias("pos", "seed"))
        .join(seeds, "seed")
        .select("doc_id", "text_key", "grams", "template", "size", "values", F.explode(numbers).alias("no"))
        .withColumn("g", F.array_distinct(F.slice("grams", F.col("no") * size + 1, 2 * size)))
        .drop("grams")
    )
    same = F.exists("values", lambda v: F.array_min(F.transform("g", lambda g: F.xxhash64(g, v["band"]))) == v["value"])
    return reached.filter(same).drop("values")


def scan(docs: DataFrame, templates: DataFrame | tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """doc_id, template (its number), license_id, n_shared, n_template and first_window.

    ``templates`` is a table (template, license_id, text) or a short list of (license_id, text). One row
    per document text and template found; n_shared is the most shingles in one window,
    first_window the first matching window's first shingle.
    """
    known = templates if isinstance(templates, DataFrame) else templates_of(docs.sparkSession, templates)
    table = saved(template_table(known))
    return (
        collisions(docs, table)
        .join(table.drop("size"), "template")
        .withColumn("n_shared", F.size(F.array_intersect("g", "t_g")).cast("long"))
        .withColumn("n_template", F.size("t_g").cast("long"))
        .filter(F.col("n_shared") * 100 >= F.col("n_template") * CONTAINED)
        .groupBy("doc_id", "text_key", "template", "license_id", "n_template")
        .agg(F.max("n_shared").alias("n_shared"), F.min(F.col("no") * F.col("size")).cast("long").alias("first_window"))
        .select("doc_id", F.col("template").cast("long").alias("template"), "license_id", "n_shared", "n_template", "first_window")
    )
