"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Words are lower-cased runs of letters and digits, shingles are five of them. A template of m shingles is looked for in
windows of 2m shingles, one at every m: any occurrence lies whole in some window. A window that holds at least
``CONTAINED`` of the template then has a Jaccard likeness of at least 0.8 m / 2.2 m = 0.36 to it, and with
``BANDS`` bands of one row each the two agree in a band with probability 1 - 0.64 ** 32 > 0.999999. A window without a
single template shingle can't agree in any band, so signatures are made of the windows around template shingles only.
Candidates are verified by the exact share of the template's distinct shingles. DataFrame functions only.

Defined cases: null text is the empty text; texts of fewer than five words match nothing; repeated rows are documents
of their own; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.work import text_of

SHINGLE, BANDS, CONTAINED = 5, 32, 0.8
# words of all templates together; they are constants of the plan
MAX_TEMPLATE_WORDS = 50_000

# fixed values: notices as their publishers word them
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _words(text: Column) -> Column:
    """Words as an array; the split leaves an empty string at either end at most."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _shingle(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def _signature(shingles: Column) -> Column:
    """One minimum for each band."""
    least = lambda band: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(band))))
    return F.array(*[least(i) for i in range(BANDS)])


def template_table(docs: DataFrame, templates: dict[str, str]) -> DataFrame:
    """``license, m, wanted`` (distinct shingles), one row for each template of at least five words."""
    rows = [(name, template_words(text)) for name, text in sorted(templates.items())]
    if sum(len(w) for _, w in rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words together")
    words = docs.sparkSession.createDataFrame(
        [(n, w) for n, w in rows if len(w) >= SHINGLE], "license string, words array<string>"
    )
    return words.select("license", (F.size("words") - SHINGLE + 1).alias("m"), _shingles(F.col("words")).alias("wanted"))


def _shingles(words: Column) -> Column:
    """The distinct shingles of a short array of words."""
    last = F.size(words) - SHINGLE + 1
    each = F.transform(
        F.sequence(F.lit(1), last),
        lambda at: _shingle([F.get(words, (at - 1 + k).cast("int")) for k in range(SHINGLE)]),
    )
    return F.when(last >= 1, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))


def windows(docs: DataFrame, known: list[int], sizes: list[int]) -> DataFrame:
    """``row, doc_id, m, window, part``: the words of every window of 2m shingles that holds a known shingle."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        # an array of one, exploded, so that the words are made once and not again at every use
        F.explode(F.array(_words(text_of()))).alias("words"),
    )
    after = [F.slice("words", F.lit(k + 1), F.size("words")) for k in range(1, SHINGLE)]
    names = [f"_{k}" for k in range(SHINGLE)]
    each = rows.select("row", "doc_id", "words", F.posexplode(F.arrays_zip(F.col("words"), *after)).alias("at", "_w"))
    parts = each.select(
        "row", "doc_id", "words", "at", *[F.col("_w").getField(n).alias(a) for n, a in zip(["words", *map(str, range(1, SHINGLE))], names, strict=True)]
    )
    hits = parts.where(F.col(names[-1]).isNotNull() & _shingle([F.col(n) for n in names]).isin(known))
    covering = F.array(*[F.struct(F.lit(m).alias("m"), F.floor(F.col("at") / m).cast("long").alias("last")) for m in sizes])
    placed = hits.select("row", "doc_id", "words", F.explode(covering).alias("_c")).select(
        "row", "doc_id", "words", F.col("_c.m").alias("m"), F.explode(F.array(F.col("_c.last") - 1, F.col("_c.last"))).alias("window")
    )
    begin = (F.col("window") * F.col("m")).cast("int")
    cut = F.slice("words", begin + 1, (2 * F.col("m") + SHINGLE - 1).cast("int"))
    return placed.where("window >= 0").select("row", "doc_id", "m", "window", cut.alias("part")).distinct()


def scan(docs: DataFrame, templates: dict[str, str] | None = None, contained: float = CONTAINED) -> DataFrame:
    """``doc_id, license, containment, first_word, n_words``: the best window of each document for each license in it."""
    wanted = template_table(docs, TEMPLATES if templates is None else templates)
    # constants of the plan, bounded by MAX_TEMPLATE_WORDS
    listed = wanted.collect()
    known = sorted({s for r in listed for s in r.wanted})
    if not known:
        known, listed = [0], []
    found = windows(docs, known, sorted({r.m for r in listed}) or [1])
    signed = found.withColumn("shingles", _shingles(F.col("part")))
    band = lambda df, *keep: df.select(*keep, "m", F.posexplode(_signature(F.col(keep[-1]))).alias("band", "least"))
    met = band(signed, "row", "doc_id", "window", "part", "shingles").join(
        band(wanted, "license", "wanted"), ["m", "band", "least"]
    )
    one = met.groupBy("row", "doc_id", "m", "window", "license").agg(
        F.any_value("part").alias("part"), F.any_value("shingles").alias("shingles"), F.any_value("wanted").alias("wanted")
    )
    share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    verified = one.withColumn("containment", share).where(F.col("containment") >= contained)
    return (
        verified.groupBy("row", "doc_id", "license")
        .agg(F.max(F.struct("containment", -F.col("window"), "m")).alias("best"))
        .select(
            "doc_id", "license", "best.containment", (-F.col("best.col2") * F.col("best.m")).cast("long").alias("first_word"),
            (2 * F.col("best.m") + SHINGLE - 1).cast("long").alias("n_words"),
        )
    )
