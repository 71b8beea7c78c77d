"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them (DataFrame operations only).

Words are runs of letters and digits, lower-cased; shingles are five words. A template of m shingles belongs to the class
M = 2, 4, 8 ... with M / 2 < m <= M (1 for m = 1). For each class, windows of 2 M shingles start at every M-th one, so any stretch of M shingles lies whole in
some window. A window that holds a share c of a template's shingles has a Jaccard similarity of c m / (2 M + (1 - c) m)
with it at least, which is over 0.18 for c = 0.8, m > M / 2. There are 32 bands of one row each: a band collides with the probability of
that similarity, so a window is missed with a probability under (1 - 0.18)^32 = 0.002 (and under 0.0001 for whole copies).

A band's values can only be equal if the window holds the very shingle that is least in the template. So the scan first
keeps the documents that hold a shingle which is some template's least in some band; windows of other documents could not collide.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import checked, stage
from tributary.llm.license_texts import TEXTS

WIDTH = 5
BANDS = 32
CONTAINMENT = 0.8
#: Bytes of all templates together, at most; what is sent to the executors of them is in proportion.
MOST_BYTES = 4 << 20

#: Notices and whole texts by the name that they are reported under.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
} | TEXTS


def words(column: str = "text") -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def hashes(w: Column) -> Column:
    """Hashes of the shingles of an array of words; empty under five words."""
    n = F.size(w) - (WIDTH - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WIDTH)]))).otherwise(F.array().cast("array<bigint>"))


def strings(w: Column) -> Column:
    n = F.size(w) - (WIDTH - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(w, i, WIDTH), " "))).otherwise(F.array().cast("array<string>"))


def _band(h: Column, b: int) -> Column:
    """Mixed hashes of one band, each with the hash that it comes from."""
    return F.transform(h, lambda x: F.struct(F.xxhash64(x, F.lit(b)).alias("mixed"), x.alias("own")))


def bands(h: Column) -> Column:
    """The least mixed hash of each band."""
    return F.array(*[F.array_min(_band(h, b))["mixed"] for b in range(BANDS)])


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """template, class, shingles (distinct strings), marks (hashes of the shingles that are least in some band), bands: as many rows as templates are given."""
    short = [k for k, v in templates.items() if len(re.findall(r"[^\W_]+", v)) < WIDTH]
    if short:
        raise ValueError(f"templates need {WIDTH} words: {short}")
    if sum(len(v.encode()) for v in templates.values()) > MOST_BYTES:
        raise ValueError(f"templates are over {MOST_BYTES} bytes")
    t = spark.createDataFrame(sorted(templates.items()), "template string, text string").withColumn("w", words())
    t = t.withColumn("hashes", F.array_distinct(hashes(F.col("w")))).withColumn("shingles", F.array_distinct(strings(F.col("w"))))
    size = F.size(hashes(F.col("w")))
    cls = F.lit(1 << 21)  # more shingles than MOST_BYTES hold
    for power in range(20, -1, -1):
        cls = F.when(size <= 1 << power, F.lit(1 << power)).otherwise(cls)
    least = F.array(*[F.array_min(_band(F.col("hashes"), b))["own"] for b in range(BANDS)])
    return t.select("template", cls.cast("int").alias("class"), "shingles", F.array_distinct(least).alias("marks"), bands(F.col("hashes")).alias("bands"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, found): uid, doc_id of each row of docs; and uid, doc_id, template, containment (the best window's), first_word (of that window, from 0) of each template in it."""
    spark = docs.sparkSession
    given = template_table(spark, templates or TEMPLATES).collect()  # as many rows as templates are given
    known = spark.createDataFrame(given)
    least = F.posexplode("bands").alias("band", "least")
    table = known.select("template", F.col("class").cast("int").alias("class"), least)
    marks = sorted({h for r in given for h in r["marks"]})
    classes = {c: sorted({h for r in given if r["class"] == c for h in r["marks"]}) for c in sorted({r["class"] for r in given})}
    marked = lambda c: F.arrays_overlap("h", F.array(*[F.lit(m) for m in classes[c]]))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", words().alias("w"))
    rows = rows.withColumn("h", hashes(F.col("w"))).withColumn("marked", F.arrays_overlap("h", F.array(*[F.lit(m) for m in marks])))
    every = stage(rows.select("uid", "doc_id", "marked", F.when(F.col("marked"), F.col("w")).alias("w"), F.when(F.col("marked"), F.col("h")).alias("h")), "marked")
    rows = every.where("marked")
    # only windows that hold a mark of their own class can collide
    starts = rows.withColumn("class", F.explode(F.array_compact(F.array(*[F.when(marked(c), F.lit(c)) for c in classes]))))
    last = F.greatest(F.lit(0), F.call_function("div", F.size("h") - 1, F.col("class"))).cast("int")
    wins = starts.withColumn("k", F.explode(F.sequence(F.lit(0), last)))
    at = F.col("k") * F.col("class")
    wins = wins.select("uid", "doc_id", "class", at.alias("at"), F.slice("h", at + 1, 2 * F.col("class")).alias("h"), F.slice("w", at + 1, 2 * F.col("class") + WIDTH - 1).alias("w"))
    wins = wins.where(reduce(or_, [(F.col("class") == c) & marked(c) for c in classes]))
    keyed = wins.select("uid", "doc_id", "class", "at", "w", F.posexplode(bands(F.col("h"))).alias("band", "least"))
    met = keyed.join(checked(table), ["class", "band", "least"])
    met = met.dropDuplicates(["uid", "at", "template"]).join(F.broadcast(known.select("template", "shingles")), "template")  # MOST_BYTES and five times as much
    share = F.size(F.array_intersect("shingles", strings(F.col("w")))) / F.size("shingles")
    found = met.select("uid", "doc_id", "template", "at", share.alias("containment")).where(F.col("containment") >= CONTAINMENT)
    found = found.groupBy("uid", "doc_id", "template").agg(F.max("containment").alias("containment"), F.min_by("at", F.struct(-F.col("containment"), F.col("at"))).alias("first_word"))
    return every.select("uid", "doc_id"), found


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_licenses, licenses (names by code point, joined by commas; empty if none), containment (the best, 0 if none).

    Null and empty texts have no license. Templates need five words. Whole texts are read, however long. Repeated rows are
    scanned one by one. An empty table gives an empty result. Other columns are ignored.
    """
    rows, found = scan(docs, templates)
    found = found.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("template")), ",").alias("names"), F.max("containment").alias("best"))
    out = rows.join(found, "uid", "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_licenses"), F.coalesce("names", F.lit("")).alias("licenses"), F.coalesce("best", F.lit(0.0)).alias("containment"))
