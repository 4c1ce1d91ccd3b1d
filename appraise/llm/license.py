"""License scan with DataFrame functions only: MinHash bands retrieve templates, shingle containment verifies them.

Words are runs of letters, digits and non-ASCII characters of the lower-cased text; shingles are five words. A
window is ``SPAN`` shingles, and the next begins ``STEP`` shingles later. A band is one MinHash of a window: the least
of its shingles' hashes, hashed anew with the band's number. A template's windows begin at every shingle. A text window that holds
the only shingle of the shortest possible template agrees with it in one of the 48 bands with probability
1 - (5/6)^48 = 0.9998; one that lies within a longer template agrees surely, since one of its windows is equal.

A retrieved template is verified on the words themselves: of its distinct shingles, at least 75 of 100 must occur
in the text from twice its length before the window to twice its length after it. Matching shingles meet the windows by
bins of that size, so that a text full of one license does not pair all of it with all of it.

Defined results: null and wordless texts have no matches; equal rows each get theirs; ids may be null; other columns are
ignored. A template must have at least five words.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm.tables import row_key

SHINGLE, SPAN, STEP, BANDS, SHARE = 5, 6, 5, 48, (75, 100)
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Short notices by which texts state their license, and the opening terms of some licenses (public texts).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
]


def template_words(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())


def _worded(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with a key (equal for equal id and text only) and the words of the text."""
    text = F.col("text").cast("string")
    words = F.filter(F.split(F.lower(text), _SEPARATORS), lambda w: w != "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("key"), F.coalesce(words, F.array().cast("array<string>")).alias("w"))


def _shingle(i) -> list:
    return [F.get("w", i + j) for j in range(SHINGLE)]


def matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """key, doc_id, template (its place in the list), first (word), contained, size: the best region of each template that a text has."""
    spark = docs.sparkSession
    worded = [template_words(t) for _, t in templates]
    if any(len(w) < SHINGLE for w in worded):
        raise ValueError(f"a template has fewer than {SHINGLE} words")
    table = spark.createDataFrame([(i, w, len(w) - SHINGLE + 1) for i, w in enumerate(worded)], "template int, w array<string>, m int")
    of_template = table.select("template", "m", "w", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("at"))

    def band(hashes, j):
        return F.xxhash64(j, F.least(*[F.when(h.isNotNull(), F.xxhash64(h, j)) for h in hashes]))

    def banded(rows, hash_of, keep):
        """Each window (a row of ``rows``) once for each band, with the band's key."""
        wide = rows.select(*keep, *[hash_of(o).alias(f"x{o}") for o in range(SPAN)], F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("j"))
        return wide.select(*keep, band([F.col(f"x{o}") for o in range(SPAN)], F.col("j")).alias("band"))

    def hashed(at, size):
        return F.when(at < size, F.xxhash64(*_shingle(at)))
    listed = banded(of_template, lambda o: hashed(F.col("at") + o, F.col("m")), ["template", "m"]).distinct()
    rows = _worded(docs)  # not filtered by size: the filter would make the words a second time
    hashes = F.when(F.size("w") >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size("w") - SHINGLE), lambda i: F.xxhash64(*_shingle(i))))
    windows = rows.select("key", hashes.alias("h")).select(
        "key", "h", F.explode(F.sequence(F.lit(0), F.floor((F.size("h") - 1) / STEP).cast("int"))).alias("k"))
    # the templates are a list in code: their bands, windows and shingles are a few thousand rows
    found = (banded(windows, lambda o: F.get("h", F.col("k") * STEP + o), ["key", "k"])
             .join(F.broadcast(listed), "band").select("key", "template", "m", "k").distinct())
    reach = 2 * F.col("m")
    bin_size = F.col("m") * 4 + SPAN
    low, high = F.col("k") * STEP - reach, F.col("k") * STEP + (SPAN - 1) + reach
    regions = found.select("key", "template", "m", "k", low.alias("low"), high.alias("high"), F.explode(
        F.sequence(F.floor(F.greatest(low, F.lit(0)) / bin_size), F.floor(high / bin_size))).alias("bin"))
    spelled = F.concat_ws(" ", *_shingle(F.col("at")))
    exact = of_template.select("template", "m", spelled.alias("s"), F.xxhash64(*_shingle(F.col("at"))).alias("x")).distinct()
    total = exact.groupBy("template").agg(F.count("*").cast("int").alias("size"))
    # outer: for a plain explode the optimizer tests the array's size below it, and would make the words anew for each shingle there
    placed = rows.select("key", "w", hashes.alias("h")).select("key", "w", F.posexplode_outer("h").alias("at", "x")).join(F.broadcast(exact), "x") \
        .where(spelled == F.col("s")).select("key", "template", F.floor(F.col("at") / bin_size).alias("bin"), "at", "x")
    met = regions.join(placed, ["key", "template", "bin"]).where("at between low and high")
    score = met.groupBy("key", "template", "k").agg(F.size(F.collect_set("x")).alias("contained"), F.min("at").alias("first"))
    good = score.join(F.broadcast(total), "template").where(SHARE[1] * F.col("contained") >= SHARE[0] * F.col("size"))
    best = good.groupBy("key", "template").agg(F.max(F.struct("contained", (-F.col("first")).alias("back"), "size")).alias("b"))
    return best.select("key", "template", (-F.col("b.back")).alias("first"), "b.contained", "b.size")


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, n_matches, licenses (names, sorted, comma-joined), first_word (-1 if none) for every row."""
    names = docs.sparkSession.createDataFrame([(i, n) for i, (n, _) in enumerate(templates)], "template int, license string")
    per = (matches(docs, templates).join(F.broadcast(names), "template").groupBy("key")
           .agg(F.count("*").alias("n_matches"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.min("first").alias("first_word")))
    return (_worded(docs).select("doc_id", "key").join(per, "key", "left")
            .select("doc_id", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.coalesce("licenses", F.lit("")).alias("licenses"),
                    F.coalesce("first_word", F.lit(-1)).cast("long").alias("first_word")))
