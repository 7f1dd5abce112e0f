"""Hard negatives against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import TESTDATA, rows_of
from tripmill.llm import hard_negatives as module
from tripmill.llm.hard_negatives import hard_negatives, scores, strassen, window_of
from tripmill.llm.queries import op13_hard_negatives

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every, k=5):
    usable = {
        (i, label, tuple(math.floor(256 * x) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, label, v in usable:
        if i % every:
            continue
        dot = lambda w: sum(x * y for x, y in zip(v, w))  # noqa: E731, B023
        order = lambda found: sorted(found, key=lambda r: (-r[0], r[1]))
        for p, pid in order([(dot(w), j) for j, other, w in usable if other == label and j != i])[:k]:
            low = [(dot(w), j) for j, other, w in usable if other != label and j != i]
            near = order([(n, j) for n, j in low if 80 * p <= 100 * n <= 100 * p])[:k]
            out += [(i, pid, rank, j, p, n) for rank, (n, j) in enumerate(near, 1)]
    return sorted(out, key=repr)


def run(spark, rows, every):
    frame = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    return rows_of(hard_negatives(frame, F.col("vec_id") % every == 0), *COLUMNS)


def test_table(spark):
    rows = spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect()
    moved = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]
    want = brute(moved, 100)
    assert len(want) > 20 and rows_of(op13_hard_negatives(spark, TESTDATA), *COLUMNS) == want


@pytest.fixture(scope="module")
def clouds():
    """Close vectors of a few labels, many ties, one common vector, two widths."""
    random.seed(5)
    rows = []
    for i in range(700):
        v = [random.choice([0.1, 0.2, 0.3, -0.1, 0.5]) for _ in range(random.choice([6, 6, 5]))]
        rows.append((i, [0.25] * 6 if i % 3 == 0 else v, random.choice([0, 0, 0, 1, 2])))
    return rows


def test_ties_and_common_vectors(spark, clouds):
    want = brute(clouds, 20)
    assert len(want) > 300 and run(spark, clouds, 20) == want


def test_small_cells_and_tiles(spark, clouds, monkeypatch):
    for name, value in (("BLOCK", 7), ("CHUNK", 90), ("TILE", 16), ("LEAF", 2)):
        monkeypatch.setattr(module, name, value)
    assert run(spark, clouds, 20) == brute(clouds, 20)


def test_odd_rows(spark):
    good = [(n, [0.5, 0.1 * n], n % 2) for n in range(1, 9)]
    rows = good + [
        (0, [1.0, 1.0], 0), (0, [1.0, 1.0], 0), (10, None, 0), (20, [1.0, None], 0), (30, [float("nan"), 1.0], 1), (40, [float("inf"), 0.0], 1),
        (None, [1.0, 1.0], 0), (50, [1.0, 1.0], None), (60, [], 0), (70, [1.0], 1), (0, [0.25, 0.25], 1), (8, [0.5, 0.8], 1),
    ]
    want = brute(rows, 10)
    assert want and run(spark, rows, 10) == want
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' block", "1 chunk", "2 tie", "3 vector")
    assert run(spark, extra, 10) == want
    assert run(spark, spark.createDataFrame([], SCHEMA), 10) == []
    assert run(spark, good, 1000) == []


def test_scores_beyond_64_bits_keep_their_order(spark):
    rows = [(0, [1e30, 1.0], 0), (1, [1e30, 0.0], 0), (2, [1e29, 3.0], 1), (3, [-1e30, 0.0], 1), (4, [1e30, 5.0], 1)]
    out = run(spark, rows, 10)
    top = (1 << 63) - 1
    assert out == [(0, 1, 1, 2, top, top), (0, 1, 2, 4, top, top)]


def test_window_bounds_are_exact():
    for p in range(-30, 200):
        low, high = window_of(p, 80, 100)
        assert [n for n in range(-300, 300) if 80 * p <= 100 * n <= 100 * p] == list(range(low, high + 1))


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 65, 40), (100, 64, 129), (70, 3, 70), (64, 64, 64)])
def test_strassen_is_the_product(shape, monkeypatch):
    monkeypatch.setattr(module, "LEAF", 8)
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-(1 << 20), 1 << 20, (m, k)), rng.integers(-(1 << 20), 1 << 20, (k, n))
    assert (strassen(a, b) == a @ b).all()
    big = rng.integers(-(1 << 62), 1 << 62, (m, k))  # wraps on the way, not in the result
    assert (strassen(big, np.eye(k, dtype=np.int64)) == big).all()
    assert (scores(a.astype(float), b.T.astype(float)) == a @ b).all()
