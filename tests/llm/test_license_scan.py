"""License scan against exact containment in every window, and planted notices."""

import random
import re

from tests.llm.conftest import rows_of
from tripmill.llm.license_scan import CONTAINMENT, OVERLAP, SIBLINGS, TEMPLATES, WIDTH, WINDOW_FACTOR, miss_probability, scan_licenses


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(words):
    return {tuple(words[n : n + WIDTH]) for n in range(len(words) - WIDTH + 1)}


def brute(rows):
    out = []
    for i, text in rows:
        words, found, names, best = tokens(text), set(), set(), 0.0
        for number, (name, template) in enumerate(TEMPLATES):
            want = tokens(template)
            width = -(-int(100 * (len(want) - WIDTH + 1) * WINDOW_FACTOR) // 100)
            step = max(1, width // OVERLAP)
            for start in range(0, max(0, len(words) - WIDTH + 1), step):
                part = words[max(0, start - step) : start + width + step + WIDTH - 1]
                core = words[start : start + width + WIDTH - 1]
                held = len(shingles(want) & shingles(part)) / len(shingles(want))
                if held >= CONTAINMENT and shingles(core) & shingles(want):
                    found.add(number)
                    names.add(name)
                    best = max(best, held)
        out.append((i, len(words), len(found), ",".join(sorted(names)), best))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_matches", "licenses", "containment")


def test_edges_and_table(edges, edge_docs, small_docs):
    assert rows_of(scan_licenses(edge_docs), *COLUMNS) == brute(edges)
    assert rows_of(scan_licenses(small_docs[1]), *COLUMNS) == brute(small_docs[0])
    assert any(r[2] for r in brute(small_docs[0]))


def test_planted(spark):
    random.seed(4)
    noise = lambda n: " ".join(f"w{random.randint(0, 5000)}" for _ in range(n))
    rows = []
    for n, (name, text) in enumerate(TEMPLATES):
        rows.append((n, f"{noise(random.randint(0, 90))}\n{text.upper()} {noise(40)}"))
        words = text.split()
        if len(words) > 30:  # one word changed: five of many shingles
            words[len(words) // 2] = "changed"
            rows.append((100 + n, f"{noise(17)} {' '.join(words)}"))
            rows.append((200 + n, f"{noise(17)} {' '.join(words[:8])} {noise(9)}"))
    out = {r.doc_id: r.licenses for r in scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for n, (name, text) in enumerate(TEMPLATES):
        assert out[n] == name
        if 100 + n in out:
            assert out[100 + n] == name and out[200 + n] == ""


def test_guarantee_and_empty(empty_docs):
    assert miss_probability() < 1e-5 and miss_probability(1.0) < 1e-8
    assert scan_licenses(empty_docs).collect() == []


def test_siblings_are_told_apart(spark):
    noise = " ".join(f"w{n}" for n in range(90))
    known = [*TEMPLATES, *SIBLINGS]
    strange = [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 4 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 4.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-1.1",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    ]
    texts = [text for _, text in known] + strange + [f"{known[4][1]} {noise} {SIBLINGS[1][1]}"]
    rows = [(n, f"{noise}\n{text} {noise}") for n, text in enumerate(texts)]
    out = {r.doc_id: r.licenses for r in scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = [name for name, _ in known] + [""] * len(strange) + ["GPL-2.0,GPL-3.0"]
    assert [out[n] for n in range(len(rows))] == want
