"""The registered queries: names, columns and types of the contracts, and DuckDB where SQL exists."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.llm.conftest import TESTDATA
from tripmill.llm.oracle import ORACLES
from tripmill.llm.queries import QUERIES

CONTRACTS = {
    1: "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    2: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    3: "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    4: "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    5: "doc_id bigint, n_words bigint, n_matches bigint, licenses string, containment double",
    6: "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    7: "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
       "base_failed boolean, kept boolean, n_lines_removed bigint, chars_removed bigint",
    8: "doc_id bigint, held_out boolean, score double, predicted int",
    9: "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    10: "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    11: "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string",
    12: "page_id bigint, url string, text string, n_chars bigint",
    13: "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == sorted(CONTRACTS)
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract(name, spark, small_docs):
    out = QUERIES[name](spark, TESTDATA)
    assert ", ".join(f"{c} {t}" for c, t in out.dtypes) == CONTRACTS[int(name[2:].split("_")[0])]
    if "doc_id" in out.columns:
        assert {r.doc_id for r in out.select("doc_id").collect()} == {i for i, _ in small_docs[0]}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    expected = connection.sql(ORACLES[name])
    out = QUERIES[name](spark, TESTDATA).select(*expected.columns)
    kinds = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean"}
    assert [kinds[str(t)] for t in expected.types] == [t for _, t in out.dtypes]
    assert Counter(map(tuple, out.collect())) == Counter(expected.fetchall())
