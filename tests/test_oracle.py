"""Every query of the reference's operators against DuckDB: same columns, types and rows."""

from collections import Counter

import pytest

import __spark_entry__ as entry_module
from tripmill.checks.oracle import ORACLES
from tripmill.checks.queries import QUERIES


def _rows(records, columns, wanted):
    positions = [columns.index(name) for name in wanted]
    return Counter(tuple(record[p] for p in positions) for record in records)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, duck, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    wanted = sorted(expected.columns)
    assert sorted(result.columns) == wanted

    duck_types = dict(zip(expected.columns, map(str, expected.types)))
    same = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
            "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}
    for field in result.schema:
        assert same[duck_types[field.name]] == field.dataType.simpleString(), field.name

    got = _rows(result.collect(), result.columns, wanted)
    want = _rows(expected.fetchall(), expected.columns, wanted)
    assert sum(want.values()) > 0
    assert got == want


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
