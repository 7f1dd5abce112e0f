"""The pipeline's stages against plain Python, each on its own input."""

from tests.llm import brute
from tests.llm.conftest import TESTDATA, rows_of

import __spark_entry__ as entry_module
import corpus_pipeline


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_stages_on_the_table(spark, small_docs):
    docs = small_docs[1]
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]

    good = steps["quality_rules"](spark, docs, TESTDATA)
    assert good.columns == docs.columns
    failed = {i for i, *_, f in brute.op7_base(small_docs[0]) if f}
    rows = pairs(good)
    assert not failed & {i for i, _ in rows} and len(rows) > 0.7 * (len(small_docs[0]) - len(failed))

    fewer = steps["line_dedup"](spark, good, TESTDATA)
    want = {i: sha for i, _, _, sha in brute.op1(rows)}
    assert fewer.columns == docs.columns
    assert {i: brute.sha(t) for i, t in pairs(fewer)} == want
    assert fewer.filter("n_chars <> length(text)").count() == 0

    single = steps["near_dedup"](spark, fewer, TESTDATA)
    rows = pairs(fewer)
    kept = {i for i, *_, k in brute.op3(rows, width=5, percent=80) if k}
    assert {i for i, _ in pairs(single)} == kept and single.columns == docs.columns

    clean = steps["decontamination"](spark, single, TESTDATA)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    rows = pairs(single)
    bad = {i for i, *_, c in brute.op6(rows, items) if c}
    assert {i for i, _ in pairs(clean)} == {i for i, _ in rows} - bad and clean.columns == docs.columns

    packed = steps["packing"](spark, clean, TESTDATA).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in rows} - bad


def test_run_and_registration(spark):
    assert entry_module.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, TESTDATA)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 50


def test_edge_rows_and_extra_columns(spark, edge_docs):
    docs = edge_docs
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, TESTDATA)
        if name != "packing":
            assert out.columns == edge_docs.columns
        out.count()
        docs = out
    kept = rows_of(edge_docs, "doc_id", "kept", "n_lines")
    after = rows_of(corpus_pipeline.quality(spark, edge_docs, TESTDATA), "doc_id", "kept", "n_lines")
    assert set(after) <= set(kept)


def test_empty(spark, empty_docs):
    docs = empty_docs
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, TESTDATA)
    assert docs.collect() == []


def test_ids_with_several_texts_and_null_ids_in_near_dedup(spark):
    """An id stays if one of its rows is kept; rows without an id stay."""
    one, two = "a b c d e f g h", "p q r s t u v w"
    rows = [(1, one), (2, one), (2, two), (3, two), (3, one), (None, one), (None, two), (4, None), (5, one), (5, one)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = corpus_pipeline.near_duplicates(spark, docs, TESTDATA)
    assert rows_of(out, "doc_id", "text") == sorted([r for r in rows if r[0] not in (3, 5)], key=repr)
