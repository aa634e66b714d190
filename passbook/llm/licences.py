"""License scans: MinHash bands over overlapping text windows retrieve templates, shingles verify them.

Templates are grouped in size classes by their number of distinct five-word shingles: class c holds 2**c to
2**(c+1) - 1. A class is searched in windows of 4 * 2**c shingles that start every 2**c, so that any passage of
up to 3 * 2**c shingles lies whole in a window, room for half as many insertions as the longest
template has shingles. A window that holds four fifths of a template is then at least
J = 0.8 / (4 + 0.2) similar to it, and ``bands()`` bands of one MinHash value each miss it with a
probability below ``MISS``.

A band can only agree where a window holds the very shingle that is the template's minimum. Documents
without any such shingle, nearly all, are passed over in the scan, and of the others only the
windows around such shingles get signatures. That leaves out nothing that a band could retrieve.
Retrieved windows are verified on the shingles' text. Everything runs on SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passbook.llm.columns import lower_ascii, quoted
from passbook.workspace import stored

SHINGLE = 5
THRESHOLD = 0.8
MISS = 1e-6
#: So many template minima are put into the scan as constants; more are joined.
CONSTANTS = 20_000
_SIGNS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Notices as licenses word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "Apache-2.0 disclaimer": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "BSD conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}


def templates_frame(spark: SparkSession) -> DataFrame:
    """The templates above as ``license, template``."""
    rows = F.array(*(F.struct(F.lit(k).alias("license"), F.lit(v).alias("template")) for k, v in TEMPLATES.items()))
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.license", "t.template")


def bands() -> int:
    similarity = THRESHOLD / (4 + 1 - THRESHOLD)
    return math.ceil(math.log(MISS) / math.log(1 - similarity))


def _words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SIGNS), lambda w: w != "")


def _grams(words: Column) -> Column:
    """The runs of five words, repeats included; none for fewer words."""
    count = F.size(words) - (SHINGLE - 1)
    runs = F.transform(F.sequence(F.lit(1), count), lambda k: F.concat_ws(" ", F.slice(words, k, SHINGLE)))
    return F.when(count > 0, runs).otherwise(F.array().cast("array<string>"))


def _hashes(words: Column) -> Column:
    """A 64-bit hash of each run of five words, without making its text."""
    count = F.size(words) - (SHINGLE - 1)
    parts = lambda k: [F.element_at(words, k + j) for j in range(SHINGLE)]
    runs = F.transform(F.sequence(F.lit(1), count), lambda k: F.xxhash64(*parts(k)))
    return F.when(count > 0, runs).otherwise(F.array().cast("array<bigint>"))


def _band_values(n_bands: int) -> list[Column]:
    return [F.min(F.xxhash64("h", F.lit(k))).alias(f"band{k}") for k in range(n_bands)]


def _as_bands(n_bands: int) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(k).alias("band"), F.col(f"band{k}").alias("value")) for k in range(n_bands))))


def _places(wanted: Column) -> Column:
    """Positions of the wanted hashes."""
    return F.filter(F.transform("hashes", lambda h, p: F.when(F.array_contains(wanted, h), p)), lambda p: p.isNotNull())


def _windows_at(hits: Column, words: Column, exponent: int) -> Column:
    """The windows of a class that hold one of the shingles at ``hits``."""
    step, size = 1 << exponent, 4 << exponent
    first = lambda p: F.greatest(F.lit(0), F.ceil((p - size + 1) / step).cast("int"))
    last = lambda p: F.floor(p / step).cast("int")
    numbers = F.array_distinct(F.flatten(F.transform(hits, lambda p: F.sequence(first(p), last(p)))))
    return F.transform(
        numbers,
        lambda k: F.struct(
            F.lit(exponent).alias("class"), k.alias("number"), F.slice(words, k * step + 1, F.lit(size + SHINGLE - 1)).alias("words")
        ),
    )


def scan(
    docs: DataFrame,
    templates: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    license_column: str = "license",
    template_column: str = "template",
    constants: int = CONSTANTS,
) -> DataFrame:
    """``doc_id, license, n_shared, n_shingles, containment`` for each document row and template found in it.

    ``n_shared`` is the most shingles of the template that one passage holds, at least four fifths of
    ``n_shingles``. Words are runs of letters and digits, A-Z lowered. Templates of fewer than five words, null
    and empty templates are found nowhere; null and short texts hold none. Repeated rows and repeated templates
    give a row each; null ids stay null; empty tables give an empty result; other columns are ignored.
    """
    n_bands = bands()
    listed = templates.select(quoted(license_column).alias("license"), quoted(template_column).alias("text"))
    listed = listed.withColumn("template", F.monotonically_increasing_id())
    grams = listed.select("template", "license", F.array_distinct(_grams(_words(F.col("text")))).alias("grams")).filter("size(grams) > 0")
    sized = grams.withColumn("total", F.size("grams")).withColumn("class", F.floor(F.log2(F.col("total") + 0.5)).cast("int"))
    sized = stored(sized, "templates")
    each = sized.select("template", "class", F.explode("grams").alias("gram"))
    each = each.withColumn("h", F.xxhash64(*(F.element_at(F.split("gram", " "), k) for k in range(1, SHINGLE + 1))))
    minima = [F.min_by("h", F.xxhash64("h", F.lit(k))).alias(f"at{k}") for k in range(n_bands)]
    signed = stored(each.groupBy("template", "class").agg(*_band_values(n_bands), *minima), "signatures")
    wanted = signed.select("class", F.explode(F.array(*(f"at{k}" for k in range(n_bands)))).alias("h")).distinct()
    wanted = stored(wanted, "minima")
    rows = docs.select(
        quoted(id_column).alias("doc_id"), _words(quoted(text_column)).alias("words"), F.monotonically_increasing_id().alias("row")
    )
    rows = rows.withColumn("hashes", _hashes(F.col("words")))
    if wanted.count() <= constants:
        by_class: dict[int, list[int]] = {}
        for row in wanted.collect():  # at most ``constants`` numbers
            by_class.setdefault(row["class"], []).append(row["h"])
        any_ = F.array(*map(F.lit, sorted({h for hs in by_class.values() for h in hs}))).cast("array<bigint>")
        none = F.array().cast("array<struct<class:int,number:int,words:array<string>>>")
        found = none
        for exponent, hs in sorted(by_class.items()):
            own = F.array(*map(F.lit, sorted(hs))).cast("array<bigint>")
            found = F.concat(found, _windows_at(_places(own), F.col("words"), exponent))
        # decided inside the generator: as a filter, the test would be pushed below the word lists and split
        # the text once for every word
        found = F.when(F.arrays_overlap("hashes", any_), found).otherwise(none)
        rows = rows.select("row", "doc_id", F.explode(found).alias("w"))
        windows = rows.select("row", "doc_id", "w.class", "w.number", "w.words")
    else:
        rows = stored(rows, "hashed")
        hits = rows.select("row", F.posexplode("hashes").alias("p", "h")).join(wanted, "h")
        step = F.pow(F.lit(2), F.col("class")).cast("int")
        first = F.greatest(F.lit(0), F.ceil((F.col("p") - step * 4 + 1) / step).cast("int"))
        numbers = F.explode(F.sequence(first, F.floor(F.col("p") / step).cast("int")))
        hits = hits.select("row", "class", numbers.alias("number")).distinct()
        windows = hits.join(rows.select("row", "doc_id", "words"), "row").select(
            "row", "doc_id", "class", "number", F.slice("words", F.col("number") * step + 1, step * 4 + (SHINGLE - 1)).alias("words")
        )
    windows = stored(windows, "windows")
    place = ["row", "class", "number"]
    hashed = windows.select(*place, F.explode(_hashes(F.col("words"))).alias("h"))
    signatures = hashed.groupBy(*place).agg(*_band_values(n_bands)).select(*place, _as_bands(n_bands).alias("b"))
    signatures = signatures.select(*place, "b.band", "b.value")
    of_templates = signed.select("template", "class", _as_bands(n_bands).alias("b")).select("template", "class", "b.band", "b.value")
    retrieved = signatures.join(of_templates, ["class", "band", "value"]).select(*place, "template").distinct()
    texts = windows.select(*place, "doc_id", F.array_distinct(_grams(F.col("words"))).alias("own"))
    checked = retrieved.join(texts, place).join(sized.select("template", "license", "grams", "total"), "template")
    checked = checked.withColumn("shared", F.size(F.array_intersect("grams", "own"))).filter(
        F.col("shared") >= F.ceil(F.col("total") * F.lit(THRESHOLD) - 1e-9)
    )
    best = checked.groupBy("row", "doc_id", "template", "license", "total").agg(F.max("shared").alias("shared"))
    return best.select(
        "doc_id",
        "license",
        F.col("shared").cast("long").alias("n_shared"),
        F.col("total").cast("long").alias("n_shingles"),
        (F.col("shared").cast("double") / F.col("total")).alias("containment"),
    )
