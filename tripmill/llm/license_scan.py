"""License scans: MinHash bands over overlapping text windows retrieve templates, containment verifies.

Templates are short license texts. A window has a quarter more shingles (five words) than its template and
windows overlap by seven eighths. A window and a template share a band if the least shingle under one of
``BANDS`` hash functions is the same. Such a window must hold the template's own least shingle, so the scan
probes a broadcast table of these shingles (at most ``BANDS`` a template) with every word, by each shingle's
longest word, and only windows around a probe hit have their least shingles computed. Retrieved windows are
then verified: the share of the template's distinct shingles in the window, and one step around it, must
reach ``CONTAINMENT``. Sibling notices differ in a few words only (GPL-2.0, LGPL and AGPL hold more than 0.8 of the
GPL-3.0 notice), so the window must also hold the words of the template that name license and version (``NAMING``).

``miss_probability`` bounds what the bands miss: a window of w shingles that holds the share c of the m
template shingles has similarity c m / (w + (1 - c) m), and all ``BANDS`` hash functions must disagree.

Built-in expressions only; texts are read twice and never shuffled.

Defined results: null and empty texts and texts of fewer than five words have no matches; templates of
fewer than five words are an error; repeated rows get the same result each; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.decontaminate import words_of
from tripmill.llm.shared import LOWER, UPPER, ascii_lower, let, stage

WIDTH, CONTAINMENT, BANDS = 5, 0.8, 24
WINDOW_FACTOR, OVERLAP = 1.25, 8

#: Notices and opening texts of public licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _gnu(program: str, license: str, version: str) -> tuple[str, ...]:
    """The short and the long notice of a GNU license, and the one for this version only."""
    opening = f"This {program} is free software: you can redistribute it and/or modify it under the terms of the GNU {license}"
    return (
        f"This work is licensed under the GNU {license}, version {version}.",
        f"{opening} as published by the Free Software Foundation, either version {version} of the License, or (at your "
        "option) any later version.",
        f"{opening} version {version} as published by the Free Software Foundation.",
        f"{opening} as published by the Free Software Foundation, version {version}.",
    )


_GNU = (
    ("GPL-2.0", "program", "General Public License", "2"),
    ("GPL-3.0", "program", "General Public License", "3"),
    ("LGPL-2.0", "library", "Library General Public License", "2"),
    ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "program", "Lesser General Public License", "3"),
    ("AGPL-3.0", "program", "Affero General Public License", "3"),
)

#: Notices that resemble those above.
SIBLINGS = tuple(
    (name, text) for name, *parts in _GNU for text in _gnu(*parts) if (name, text) not in TEMPLATES
) + (
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
)

#: Words that name a license and its version: those that a template has, its windows must have as well.
NAMING = {
    name: tuple(
        phrase.format(license=license.lower(), public=license.lower().removesuffix(" license"), version=version.replace(".", " "))
        for phrase in ("under the gnu {license} version {version}", "either version {version} of", "terms of the gnu {public}",
                       "license version {version} as", "foundation version {version}")
    )
    for name, _, license, version in _GNU
} | {
    "Apache-2.0": ("apache license version 2 0", "licenses license 2 0"),
    "MPL-2.0": ("mozilla public license v 2 0",),
    "EPL-1.0": ("eclipse public license v1 0",),
    "EPL-2.0": ("eclipse public license 2 0",),
}


def miss_probability(containment: float = CONTAINMENT, bands: int = BANDS) -> float:
    """Chance that no band retrieves an aligned window with this containment; one step off adds an eighth."""
    held = containment - 1 / OVERLAP
    return (1 - held / (WINDOW_FACTOR + 1 - held)) ** bands


def _mask(band: Column) -> Column:
    """A random word for each band; the least of ``hash ^ mask`` is its hash function."""
    return F.xxhash64(band, F.lit("band"))


def _shingle_hashes(words: Column) -> Column:
    """Hash of the shingle at each word. Words that agree but for A-Z hash alike."""
    last = F.size(words) - (WIDTH - 1)
    hashed = lambda n: F.xxhash64(F.lower(F.array_join(F.slice(words, n, WIDTH), " ")))
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), hashed)).otherwise(F.array().cast("array<bigint>"))


def _least(hashes: Column, band: Column) -> Column:
    return let(_mask(band), lambda m: F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(m))))


def _shingles(words: Column) -> Column:
    """Distinct shingles as text, A-Z lower-cased."""
    lowered = F.transform(words, lambda w: F.translate(w, UPPER, LOWER))
    last = F.size(words) - (WIDTH - 1)
    joined = lambda x: F.transform(F.sequence(F.lit(1), last), lambda n: F.array_join(F.slice(x, n, WIDTH), " "))
    return F.when(last >= 1, F.array_distinct(let(lowered, joined))).otherwise(F.array().cast("array<string>"))


def _spaced(words: Column) -> Column:
    """The words as text between blanks, A-Z lower-cased."""
    return F.concat(F.lit(" "), F.translate(F.array_join(words, " "), UPPER, LOWER), F.lit(" "))


def _holds(text: Column, phrase: Column) -> Column:
    return F.contains(text, F.concat(F.lit(" "), phrase, F.lit(" ")))


def template_table(spark: SparkSession, templates=TEMPLATES + SIBLINGS) -> DataFrame:
    """``anchor, offset, hash, template, license, shingles, naming, width, step, bands``: each template's least shingles.

    ``anchor`` is the hash of the shingle's longest word, ``offset`` that word's place in it.
    """
    rows = [(n, name, text, list(NAMING.get(name, ()))) for n, (name, text) in enumerate(templates)]
    read = spark.createDataFrame(rows, "template int, license string, text string, naming array<string>").select(
        "template", "license", words_of(ascii_lower(F.col("text"))).alias("words"), "naming"
    ).withColumn("naming", let(_spaced(F.col("words")), lambda t: F.filter("naming", lambda p: _holds(t, p))))
    sized = read.select("template", "license", "naming", "words", _shingle_hashes(F.col("words")).alias("hashes"), _shingles(F.col("words")).alias("shingles"))
    width = F.ceil(F.size("hashes") * WINDOW_FACTOR).cast("int")
    least = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    return (
        sized.select("*", width.alias("width"), F.greatest(F.lit(1), F.floor(width / OVERLAP).cast("int")).alias("step"), least)
        .withColumn("hash", _least(F.col("hashes"), F.col("band")).bitwiseXOR(_mask(F.col("band"))))
        .groupBy("hash", "template")
        .agg(
            *(F.first(c).alias(c) for c in ("license", "shingles", "naming", "width", "step", "words", "hashes")),
            F.collect_list("band").alias("bands"),
        )
        .withColumn("own", F.slice("words", F.array_position("hashes", F.col("hash")).cast("int"), WIDTH))
        .withColumn("longest", F.array_max(F.transform("own", lambda w, n: F.struct(F.length(w), -n, F.lower(w).alias("w"), n.alias("n")))))
        .select(
            F.xxhash64("longest.w").alias("anchor"), F.col("longest.n").alias("offset"),
            "hash", "template", "license", "shingles", "naming", "width", "step", "bands",
        )
    )


def find_licenses(docs: DataFrame, templates=TEMPLATES + SIBLINGS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, license, template, containment, start, end``: verified windows, in words."""
    table = F.broadcast(stage(template_table(docs.sparkSession, templates), "templates"))
    read = docs.select(
        docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), words_of(docs[text]).alias("words")
    )
    probes = (
        read.select("*", F.posexplode("words").alias("place", "word"))
        .withColumn("anchor", F.xxhash64(F.lower("word")))
        .join(table, "anchor")
        .withColumn("at", F.col("place") - F.col("offset"))
        .filter((F.col("at") >= 0) & (F.col("at") + WIDTH <= F.size("words")))
        .filter(F.xxhash64(F.lower(F.array_join(F.slice("words", F.greatest(F.col("at"), F.lit(0)) + 1, WIDTH), " "))) == F.col("hash"))
    )
    # Window starts are multiples of the step; these hold the shingle at ``at``.
    first = F.ceil(F.greatest(F.lit(0), F.col("at") - F.col("width") + 1) / F.col("step")).cast("int") * F.col("step")
    windows = probes.filter(first <= F.col("at")).select(
        "*", F.explode(F.sequence(first, F.col("at"), F.col("step"))).alias("start")
    )
    inside = _shingle_hashes(F.slice("words", F.col("start") + 1, F.col("width") + WIDTH - 1))
    retrieved = windows.filter(
        let(inside, lambda hs: F.exists("bands", lambda b: _least(hs, b) == F.col("hash").bitwiseXOR(_mask(b))))
    )
    low = F.greatest(F.lit(0), F.col("start") - F.col("step"))
    high = F.least(F.size("words"), F.col("start") + F.col("width") + F.col("step") + WIDTH - 1)
    part = F.slice("words", low + 1, high - low)
    held = F.size(F.array_intersect("shingles", _shingles(part))) / F.size("shingles")
    named = let(_spaced(part), lambda t: F.forall("naming", lambda p: _holds(t, p)))
    return (
        retrieved.filter(named)
        .select("doc_id", "text_hash", "license", "template", held.alias("containment"), low.alias("start"), high.alias("end"))
        .filter(F.col("containment") >= CONTAINMENT)
        .distinct()
    )


def scan_licenses(docs: DataFrame, templates=TEMPLATES + SIBLINGS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_matches, licenses, containment`` of every document; licenses sorted, comma-joined."""
    found = (
        find_licenses(docs, templates, doc_id, text)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.countDistinct("template").alias("n_matches"),
            F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
            F.max("containment").alias("containment"),
        )
        .withColumnsRenamed({"doc_id": "at_id", "text_hash": "at_hash"})
    )
    counted = docs.select(
        docs[doc_id].alias("doc_id"),
        F.xxhash64(docs[text]).alias("text_hash"),
        F.size(words_of(docs[text])).cast("bigint").alias("n_words"),
    )
    same = counted.doc_id.eqNullSafe(found.at_id) & (counted.text_hash == found.at_hash)
    return counted.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )
