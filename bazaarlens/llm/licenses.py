"""License scan by MinHash over text windows (operator 6), DataFrame only.

A document's lower-cased alphanumeric words are cut into windows that overlap
by half, one window size per size class of templates (at least twice the
template's shingles, so some window always holds a whole occurrence). Each
window and each template is signed with ``HASHES`` MinHash values over 5-word
shingles; every value is a band of its own. A window that holds 0.8 of the n
shingles of a template of its class resembles it by 0.8 n / (size + 0.2 n) or
more: at least 1/8 (a template of one shingle in a window of 8), so all
``HASHES`` = 96 bands miss it with probability below (7/8) ** 96 = 3e-6.
Retrieved templates are verified by exact containment of their shingles, as
words, in the window.

Windows are only made where one of the ``MARKERS`` stands: more than 0.2 of
every template's shingles hold one (checked when templates are signed), so no
match is without one and that step loses nothing. Templates are a fixed list: their
signatures are the only table that is broadcast.

Null and empty texts match nothing; every row is a document of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
HASHES = 96

# Public license notices, by name.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice":
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License.",
    "mit-line": "Released under the MIT License",
    "mit-grant":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice":
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0":
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-redistribution":
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    "mpl-2.0":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def template_words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def template_shingles(text: str) -> list[str]:
    w = template_words(text)
    return sorted({" ".join(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)})


# Words that license notices are made of. Any 0.8 of a template's
# shingles hold at least one of them.
MARKERS = ("license", "licensed", "permission", "permitted", "redistribution", "software")


def size_class(n_shingles: int) -> int:
    """Window length, in shingles, for a template: a power of two of at least
    twice its shingles, so half-overlapping windows hold it whole."""
    size = 8
    while size < 2 * n_shingles:
        size *= 2
    return size


def _mask(j: int) -> int:
    """Fixed 64-bit masks: exclusive-or with one permutes scrambled digests."""
    x = (j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & (1 << 64) - 1
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & (1 << 64) - 1
    x ^= x >> 31
    return x - (1 << 64) if x >> 63 else x


def signature(digests: Column) -> Column:
    """Array of MinHash values of an array of shingle digests."""
    def least(mask: int) -> Column:
        return F.array_min(F.transform(digests, lambda x: x.bitwiseXOR(F.lit(mask))))

    return F.array(*[least(_mask(j)) for j in range(HASHES)])


def window_starts(places: Column, size: int) -> Column:
    """Array of (size, at): the windows of ``size`` shingles, half overlapping,
    that hold a shingle with a marker; ``places`` are the markers' words. The
    word at p is in the shingles p - 4 to p, and a shingle i in the windows
    that start at i's half and at the half before."""
    half = size // 2

    def around(p):
        first = F.greatest(F.floor((p - (SHINGLE - 1)) / half) - 1, F.lit(0))
        return F.sequence(first.cast("int"), F.floor(p / half).cast("int"))

    return F.transform(F.array_distinct(F.flatten(F.transform(places, around))),
                       lambda k: F.struct(F.lit(size).alias("size"), (k * half).alias("at")))


def templates(spark: SparkSession) -> DataFrame:
    """(license, size, shingles, band, value): fixed by TEMPLATES."""
    rows = []
    for name, text in TEMPLATES.items():
        shingles = template_shingles(text)
        without = sum(not set(s.split()) & set(MARKERS) for s in shingles)
        if without >= CONTAINED * len(shingles):
            raise ValueError(f"{name}: may match without a marker")
        rows.append((name, size_class(len(shingles)), shingles))
    t = spark.createDataFrame(rows, "license string, size int, wanted array<string>")
    signed = t.select("*", F.transform("wanted", lambda s: F.xxhash64(s)).alias("digests"))
    return signed.select("license", "size", "wanted",
                         F.posexplode(signature(F.col("digests"))).alias("band", "value"))


def marked(text: Column) -> Column:
    return text.rlike("(?i)(?<![a-z0-9])(" + "|".join(MARKERS) + ")(?![a-z0-9])")


def scan(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document row: doc_id, n_licenses, licenses (names, sorted, joined by
    commas), n_windows (windows in which a template was verified)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", body.alias("body"))
    # words of marked documents only; the rest stays as rows without words
    words = rows.select("row", "doc_id", F.when(marked(F.col("body")), F.filter(F.split(
        F.lower("body"), "[^a-z0-9]+"), lambda w: w != "")).alias("w"))
    enough = F.size("w") >= SHINGLE
    following = [F.slice(F.col("w"), k + 1, F.greatest(F.size("w") - SHINGLE + 1, F.lit(0)))
                 .alias(f"w{k}") for k in range(SHINGLE)]
    places = F.filter(F.transform("w", lambda x, i: F.when(x.isin(*MARKERS), i)),
                      lambda i: i.isNotNull())
    shingled = words.select("row", "doc_id", places.alias("places"), F.when(enough, F.transform(
        F.arrays_zip(*following), lambda z: F.concat_ws(" ", *[z[f"w{k}"] for k in range(SHINGLE)])))
        .alias("s"))
    known = templates(spark)
    sizes = sorted({size_class(len(template_shingles(t))) for t in TEMPLATES.values()})
    starts = F.flatten(F.array(*[window_starts(F.col("places"), n) for n in sizes]))
    # explode twice: the shingles are computed once per document, not per window
    held = shingled.filter(F.col("s").isNotNull()).select("row", "s", starts.alias("starts"))
    cut = held.select("row", "s", F.explode("starts").alias("g")).select(
        "row", "g.size", F.slice("s", F.col("g.at") + 1, F.col("g.size")).alias("window"))
    signed = cut.filter(F.size("window") > 0).withColumn("digests", F.transform("window", lambda x: F.xxhash64(x)))
    bands = signed.select("row", "size", "window", F.posexplode(signature(F.col("digests")))
                          .alias("band", "value"))
    found = (bands.join(F.broadcast(known), ["size", "band", "value"])
             .filter(F.size(F.array_intersect("wanted", "window"))
                     >= F.lit(CONTAINED) * F.size("wanted"))
             .groupBy("row").agg(F.sort_array(F.collect_set("license")).alias("names")))
    return (rows.select("row", "doc_id").join(found, "row", "left")
            .select("doc_id", F.coalesce(F.size("names"), F.lit(0)).cast("bigint")
                    .alias("n_licenses"),
                    F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses")))
