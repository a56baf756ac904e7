"""License scans: MinHash bands over overlapping text windows find templates, exact containment verifies them.

DataFrame functions only; no Python runs on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.llm.license_texts import TEXTS

WORDS = 5
CONTAINED = 0.75
BANDS = 48
# Bits of the filter of template shingles (two of them a shingle), whatever the number of templates
FILTER_BITS = 1 << 20

# License notices of a sentence
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "Apache-2.0-header",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    (
        "BSD-redistribution",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "GPL-header",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
)


TEMPLATES = NOTICES + TEXTS


def notices(spark: SparkSession) -> DataFrame:
    """License texts and notices to look for."""
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: str) -> Column:
    """Hash of every ``WORDS`` words in a row of the array column; none if there are fewer words."""
    starts = F.sequence(F.lit(1), F.size(words) - WORDS + 1)
    every = F.transform(starts, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(WORDS)]))
    return F.when(F.size(words) >= WORDS, every).otherwise(F.array().cast("array<bigint>"))


def band_minima(shingles: str) -> Column:
    """One MinHash per band (bands of one row): the smallest of the shingles' hashes under the band's seed."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, band))),
    )


def _slots(shingle: Column) -> list[Column]:
    """The two bits of a shingle in the filter, from separate parts of its hash."""
    return [part.bitwiseAND(FILTER_BITS - 1) for part in (shingle, F.shiftrightunsigned(shingle, 32))]


def shingle_filter(sought: DataFrame) -> Column:
    """A constant array of longs, ``FILTER_BITS`` bits in all, in which the bits of all template shingles are set."""
    bits = sought.select(F.explode("sought").alias("_s")).select(F.explode(F.array(*_slots(F.col("_s")))).alias("_bit"))
    word = F.shiftright("_bit", 6).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    found = {r["word"]: r["bits"] for r in bits.groupBy(word).agg(F.bit_or(bit).alias("bits")).collect()}
    return F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(FILTER_BITS // 64))), ",").cast("array<bigint>")


def _may_be_sought(shingle: Column, bits: Column) -> Column:
    """Whether both bits of the shingle are set: true for every template shingle, and for few others."""
    first, second = (
        F.getbit(F.get(bits, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(63).cast("int")) == 1 for slot in _slots(shingle)
    )
    return first & second


def text_windows(texts: DataFrame, smallest: dict[int, int], bits: Column, every_window: bool) -> DataFrame:
    """_doc, _text, class, first_word and shingles of the windows of each text, made where the text is read.

    A window of a class is made if it holds as many places of template shingles as ``CONTAINED`` of the smallest template of
    the class asks for; with ``every_window``, all are. Work and memory grow with the text, since a place lies in two
    windows of a class.
    """
    hashed = texts.select("_doc", "_text", words_of(F.col("text")).alias("_words"))
    hashed = hashed.select("_doc", "_text", shingle_hashes("_words").alias("_all"))
    # No filter here: pushed below, it would hash the words again for every word.
    if every_window:
        places = F.when(F.size("_all") > 0, F.sequence(F.lit(0), F.size("_all") - 1)).otherwise(F.array().cast("array<int>"))
        hashed = hashed.withColumn("_hits", places)
    else:
        hashed = hashed.withColumn("_marks", F.transform("_all", lambda s: _may_be_sought(s, bits)))
        places = F.filter(F.sequence(F.lit(0), F.size("_marks") - 1), lambda at: F.coalesce(F.get("_marks", at), F.lit(False)))
        hashed = hashed.withColumn("_hits", places)

    def of_class(size: int) -> Column:
        near = F.transform("_hits", lambda at: F.floor(at / size).cast("int"))
        begins = F.array_distinct(F.concat(near, F.transform(near, lambda w: F.greatest(F.lit(0), w - 1))))
        if not every_window:
            held = lambda w: F.size(F.filter(F.slice("_marks", w * size + 1, 2 * size), lambda m: m))
            begins = F.filter(begins, lambda w: held(w) >= F.lit(CONTAINED * smallest[size]))
        return F.transform(
            begins,
            lambda w: F.struct(
                F.lit(size).alias("class"),
                (w * size).alias("first_word"),
                F.slice("_all", w * size + 1, 2 * size).alias("shingles"),
            ),
        )

    return hashed.select("_doc", "_text", F.inline(F.concat(*[of_class(size) for size in sorted(smallest)])))


def find_templates(documents: DataFrame, templates: DataFrame, every_window: bool = False) -> DataFrame:
    """doc_id, license, containment, first_word: templates (license, text) of which documents hold most.

    A template of n shingles is sought in windows of twice c shingles, c the power of two not below n, that begin at every
    multiple of c: any run of c shingles lies whole in one of them. A window that holds ``CONTAINED`` of a template has
    a Jaccard similarity of at least 3/17 to it (n just above c/2), so one of 48 bands of one MinHash agrees with a
    probability of at least 1 - (14/17)^48, above 0.9999; for a whole template of n = c it is 1 - 2^-48. Templates whose
    bands agree are verified by the exact share of their distinct shingles in the window. The best window counts, the first
    of equals; ``first_word`` is its first word's place (from 0).

    Texts are read once and move nowhere: windows too poor in template shingles to hold any template are not made, which
    a constant filter of fixed size tells where the text is read (a fuller filter only makes more windows). With
    ``every_window`` all windows are made and the bands alone retrieve; the result is the same.

    Templates of fewer than five words are refused by an error, as they have no shingle. Null and empty texts hold
    nothing; rows with a null doc_id are scanned like others; repeated rows give one result; other columns are not
    looked at. Without templates nothing is found. A shared notice on very many documents makes one row for each of them.
    """
    sought = templates.select("license", words_of(F.col("text")).alias("words"))
    sought = sought.select("license", F.array_distinct(shingle_hashes("words")).alias("sought"))
    size_class = F.pow(F.lit(2), F.ceil(F.log2(F.size("sought")))).cast("int").alias("class")
    sought = durable(sought.select("license", "sought", F.when(F.size("sought") > 0, size_class).alias("class")))
    if not sought.filter("class is null").isEmpty():
        raise ValueError("a template has fewer than five words")
    by_class = sought.groupBy("class").agg(F.min(F.size("sought")).alias("least")).collect()  # one row a power of two
    smallest = {r["class"]: r["least"] for r in by_class} or {1: 1}
    texts = documents.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"), "text"
    )
    windows = text_windows(texts, smallest, shingle_filter(sought), every_window)
    key = ["_doc", "_text", "class", "first_word"]
    asked = windows.select(*key, "shingles", F.posexplode(band_minima("shingles")).alias("band", "low"))
    offered = sought.select("license", "class", "sought", F.posexplode(band_minima("sought")).alias("band", "low"))
    met = asked.join(offered, ["class", "band", "low"])
    share = F.size(F.array_intersect("shingles", "sought")) / F.size("sought")
    sure = met.select("_doc", "_text", "license", "first_word", share.alias("containment")).filter(F.col("containment") >= CONTAINED)
    best = sure.groupBy("_doc", "_text", "license").agg(F.max(F.struct("containment", -F.col("first_word"))).alias("_best"))
    return best.select(
        F.col("_doc").alias("doc_id"),
        "license",
        F.col("_best.containment").alias("containment"),
        (-F.col("_best.col2")).cast("long").alias("first_word"),
    )
