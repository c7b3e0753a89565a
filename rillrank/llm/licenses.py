"""License scans with DataFrame functions only.

Templates are classed by length; a class scans windows of its own size at a quarter of that as step,
so that an occurrence of a template lies whole in one of the overlapping windows. A window and a
template are compared by MinHash: each of BANDS bands is the smallest of one hash over the word
shingles. One row per band makes a template and a window that holds SHARE of its shingles miss each
other in all bands with a probability below 1e-6 (`miss_probability`; checked when scanning). What
agrees in a band is verified exactly: the share of the template's shingles that the window holds.

A window can only agree with a template if it holds the shingle that is smallest in that band. So
texts, then windows, without any of those few shingles are left out before bands are computed; this
loses nothing and keeps the scan to one pass of plain expressions with no shuffle of texts. The word
hashes of the texts left are written to the shared folder, as each class reads them again.

Words are runs of letters and digits (ASCII punctuation and controls are spaces, A-Z lower-cased).
Null and empty texts, and texts with fewer than SHINGLE words, match nothing. Rows of equal id are one
document, also those without an id. Other columns of the input are ignored. An empty table, or no
templates, gives no rows. Templates need SHINGLE words at least.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillrank.llm.tables import saved

SHINGLE = 5
BANDS = 72
SHARE = 0.8
#: ASCII signs that separate words.
SEPARATORS = "\t\n\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Notices of common licenses.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "gpl-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "gpl-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at"),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words(text: Column) -> Column:
    plain = F.translate(text, UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.array_remove(F.split(F.coalesce(plain, F.lit("")), " "), "")


def _once(value: Column, use) -> Column:
    """`use(value)` with the value bound to a variable, so that no use inside it computes it again."""
    return F.get(F.transform(F.array(value), use), 0)


def shingles(parts: Column) -> Column:
    """A 64-bit hash for each run of SHINGLE words, in order."""
    def of(p: Column) -> Column:
        n = F.size(p) - SHINGLE + 1
        runs = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
                           lambda i: F.xxhash64(*[F.get(p, i + k) for k in range(SHINGLE)]))
        return F.slice(runs, F.lit(1), F.greatest(n, F.lit(0)))
    return _once(parts, of)


def bands(held: Column) -> Column:
    """The smallest value of each band's hash over the shingles."""
    return _once(held, lambda h: F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                                             lambda b: F.array_min(F.transform(h, lambda x: F.xxhash64(x, b)))))


def class_of(n_words: int) -> int:
    """The least class size that holds a template of so many words; sizes grow by a quarter."""
    size = SHINGLE + 1
    while size < n_words:
        size = max(size + 2, size * 5 // 4)
    return size


def step_of(size: int) -> int:
    return max(2, size // 4)


def width_of(size: int) -> int:
    """Shingles of a window: a template of the class lies whole in the window begun at or before it."""
    return size + step_of(size) - SHINGLE


def miss_probability(n_shingles: int, size: int) -> float:
    """That a window holding SHARE of a template agrees with it in no band."""
    held = -(-SHARE * n_shingles // 1)
    return (1 - held / (width_of(size) + n_shingles - held)) ** BANDS


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_column: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row for each document and template found in it: id, license, containment (largest share of the
    template's shingles in one window) and first_word (where the first such window begins)."""
    spark = docs.sparkSession
    empty = f"{id_column} bigint, license string, containment double, first_word bigint"
    if not templates:
        return spark.createDataFrame([], empty)
    known = spark.createDataFrame(list(templates.items()), "license string, notice string").select(
        "license", words(F.col("notice")).alias("parts")).select(
        "license", F.size("parts").alias("n_words"), F.array_distinct(shingles(F.col("parts"))).alias("wanted"))
    # Small by nature: one row per template.
    sizes: dict[int, list[str]] = {}
    for row in known.collect():
        size = class_of(row["n_words"])
        if row["n_words"] < SHINGLE or miss_probability(len(row["wanted"]), size) > 1e-6:
            raise ValueError(f"template {row['license']} is too short for the bands")
        sizes.setdefault(size, []).append(row["license"])
    least = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.array_sort(
        F.transform(F.col("wanted"), lambda x: F.struct(F.xxhash64(x, b).alias("h"), x.alias("x"))))[0]["x"]))
    smallest = {r["license"]: r["least"] for r in known.select("license", least.alias("least")).collect()}

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"),
                       shingles(words(F.col(f"`{text}`"))).alias("held"))
    every = sorted({x for found in smallest.values() for x in found})
    rows = saved(rows.where(F.arrays_overlap("held", _numbers(every))), "license-texts")
    of_size = F.coalesce(*[F.when(F.col("license").isin(names), F.lit(size)) for size, names in sizes.items()])
    known = known.withColumn("size", of_size)
    classes = F.array(*[F.struct(
        F.lit(size).alias("size"), F.lit(step_of(size)).alias("step"), F.lit(width_of(size)).alias("width"),
        _numbers(sorted({x for n in names for x in smallest[n]})).alias("marks")) for size, names in sorted(sizes.items())])
    classed = rows.select("id", "held", F.explode(classes).alias("c")).where(F.arrays_overlap("held", F.col("c.marks")))
    windows = classed.select("id", "held", "c", F.explode(F.sequence(
        F.lit(0), F.size("held") - 1, F.col("c.step"))).alias("start")).select(
        "id", "c.size", "c.marks", "start", F.slice("held", F.col("start") + 1, F.col("c.width")).alias("held"))
    windows = windows.where(F.arrays_overlap("held", "marks")).drop("marks")
    banded = windows.select("id", "size", "start", "held", F.posexplode(bands(F.col("held"))).alias("band", "least"))
    keyed = known.select("license", "size", F.posexplode(bands(F.col("wanted"))).alias("band", "least"))
    found = banded.join(F.broadcast(keyed), ["size", "band", "least"]).select(
        "id", "start", "license", "held").distinct()
    exact = found.join(F.broadcast(known.select("license", "wanted")), "license").select(
        "id", "start", "license",
        (F.size(F.array_intersect("held", "wanted")) / F.size("wanted")).alias("share"))
    best = exact.where(F.col("share") >= SHARE).groupBy("id", "license").agg(
        F.max(F.struct("share", (-F.col("start")).alias("place"))).alias("best"))
    return best.select(F.col("id").alias(id_column), "license", F.col("best.share").alias("containment"),
                       (-F.col("best.place")).cast("bigint").alias("first_word"))


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])
