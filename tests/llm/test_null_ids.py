"""Null ids and repeated rows: each row keeps a result of its own, equal to that of the same text under an id."""

import public_tokenizers
import pytest

from tests.llm.conftest import rows_of
from tripmill.llm.decontaminate import decontamination_report
from tripmill.llm.license_scan import scan_licenses
from tripmill.llm.quality_rules import quality_rules
from tripmill.llm.sharding import shard
from tripmill.llm.token_counts import token_counts
from tripmill.llm.toxicity import score_toxicity

TEXT = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
ROWS = [(None, TEXT), (None, TEXT), (None, None), (5, TEXT), (5, TEXT), (6, None), (7, "")]


def licenses(spark, docs):
    return scan_licenses(docs)


def decontaminated(spark, docs):
    return decontamination_report(docs, spark.createDataFrame([("a", TEXT), (None, TEXT)], "item_id string, text string"), window=10)


def toxic(spark, docs):
    return score_toxicity(docs, spark.createDataFrame([(5, 1, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int"))


def tokens(spark, docs):
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@pytest.mark.parametrize(
    "operator, columns",
    [
        (decontaminated, ("n_words", "n_hit", "contaminated")),
        (lambda spark, docs: quality_rules(docs), ("n_words", "word_chars", "base_failed")),
        (toxic, ("score", "predicted")),
        (tokens, ("n_bytes", "n_tokens", "over_limit")),
    ],
)
def test_a_row_each(spark, operator, columns):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    out = rows_of(operator(spark, docs), "doc_id", *columns)
    assert sorted((r[0] for r in out), key=repr) == sorted((i for i, _ in ROWS), key=repr)
    of_text = {r[1:] for r in out if r[0] == 5}
    assert len(of_text) == 1 and sum(r[0] is None and r[1:] in of_text for r in out) >= 2


def test_licenses(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    out = scan_licenses(docs).select("doc_id").collect()  # rows of documents, or of their matches
    assert {r.doc_id for r in out} >= {None, 5}


def test_shards_hold_every_row(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    out = rows_of(shard(docs, shards=4), "doc_id", "size", "shard", "slot")
    assert sorted(((r[0], r[1]) for r in out), key=repr) == sorted(((i, len((t or "").encode()) + 1) for i, t in ROWS), key=repr)
    for number in {r[2] for r in out}:
        slots = sorted(r[3] for r in out if r[2] == number)
        assert slots == list(range(slots[0], slots[0] + len(slots)))
