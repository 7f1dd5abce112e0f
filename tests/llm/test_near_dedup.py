"""Near-dedup against all pairs in plain Python."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import rows_of
from tripmill.llm.near_dedup import least_matches, near_dedup, stars
from tripmill.llm.shared import FREE_SHUFFLES, stage
from tripmill.sources.workspace import shared_root

COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def run(frame):
    return rows_of(near_dedup(frame, width=3, percent=85), *COLUMNS)


def test_edges(edges, edge_docs):
    assert run(edge_docs) == sorted(brute.op3(edges), key=repr)


def test_table(small_docs):
    assert run(small_docs[1]) == sorted(brute.op3(small_docs[0]), key=repr)


def copies(seed, n=150):
    """Groups of edited copies, copies of copies, and a chain, at similarities around the threshold."""
    random.seed(seed)
    rows, base = [], []
    for i in range(n):
        if not base or random.random() < 0.15:
            words = [f"w{random.randint(0, 400)}" for _ in range(random.randint(3, 120))]
        else:
            words = list(random.choice(base[-4:]))
            for _ in range(random.randint(0, 3)):
                words[random.randrange(len(words))] = f"x{random.randint(0, 999)}"
        base.append(words)
        rows.append((i * 3 + 1, " ".join(words)))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_groups_of_edited_copies(spark, seed):
    rows = copies(seed)
    want = sorted(brute.op3(rows), key=repr)
    assert sum(not kept for *_, kept in want) > 20
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == want


def cloud(n, low, high, seed=11, size=150):
    """Edits of one text: their similarities lie around the threshold."""
    random.seed(seed)
    rows = []
    for i in range(n):
        words = [f"w{k}" for k in range(size)]
        for _ in range(random.randint(low, high)):
            words[random.randrange(size)] = f"x{random.randint(0, 10_000)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("shingles", [1 << 21, 600])
def test_large_buckets_in_cells(spark, monkeypatch, shingles):
    for name, value in (("SMALL", 2), ("BLOCK", 4), ("BLOCK_SHINGLES", shingles)):
        monkeypatch.setattr(f"tripmill.llm.near_dedup.{name}", value)
    rows = cloud(90, 2, 7)
    want = sorted(brute.op3(rows), key=repr)
    assert 5 < len({c for *_, c, _ in want}) < 85
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == want


def test_rows_of_a_cloud_grow_with_its_members(spark, monkeypatch):
    """Most pairs just below the threshold: no component to hide behind."""
    from tripmill.llm import near_dedup as module

    dealt, cells = [], module._cells

    def counted(*tables):
        dealt.append(cells(*tables).count())
        return cells(*tables)

    monkeypatch.setattr(module, "_cells", counted)
    for n in (250, 500):
        out = run(spark.createDataFrame(cloud(n, 3, 4), "doc_id bigint, text string"))
        assert len({c for *_, c, _ in out}) > n / 2
    assert 500 < dealt[0] < dealt[1] <= 2.4 * dealt[0]


def test_recall_of_edited_copies(spark):
    rows = [(1000 * seed + i, t) for seed in range(7) for i, t in copies(seed, 140)] + [(9000 + i, t) for i, t in cloud(300, 1, 4)]
    rows = [(i, t.replace("w", f"v{i // 1000}")) for i, t in rows]  # sets of different groups share nothing
    want = [r for seed in range(10) for r in brute.op3([x for x in rows if x[0] // 1000 == seed])]
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == sorted(want, key=repr)


def test_null_ids_and_repeated_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (2, "A B\tC D"), (9, "")]
    out = run(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert out == sorted([(5, 2, 2, False), (5, 2, 2, False), (None, 2, None, True), (2, 2, 2, True), (9, 0, 9, True)], key=repr)


def test_stars_of_paths_and_hubs(spark):
    path = [(n, n + 1) for n in range(60)]
    hub = [(1000, n) for n in range(200, 260)] + [(199, 1001), (1001, 1000)]
    out = {r.v: r.root for r in stars(spark.createDataFrame(path + hub, "a bigint, b bigint")).collect()}
    assert out == {n: 0 for n in range(1, 61)} | {n: 199 for n in [*range(200, 260), 1000, 1001]}
    assert stars(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_posterior_bounds():
    bounds = least_matches(0.85)
    assert bounds == sorted(bounds) and 0 < bounds[0] < 32 * 0.85 and bounds[-1] < 192 * 0.85
    assert bounds[-1] / 192 < least_matches(0.85, 1024, 1024)[0] / 1024 < 0.85


def test_empty(empty_docs):
    assert near_dedup(empty_docs).collect() == []


def test_only_the_result_stays_staged(spark):
    def staged():
        return {(space, table) for space in os.listdir(shared_root(spark)) for table in os.listdir(f"{shared_root(spark)}/{space}")}

    before = staged()
    out = near_dedup(spark.createDataFrame(copies(1), "doc_id bigint, text string"), width=3, percent=85)
    assert [table.split("-")[0] for _, table in staged() - before] == ["judged"]
    assert rows_of(out, *COLUMNS) == sorted(brute.op3(copies(1)), key=repr)


def test_staging_deletes_its_exchanges(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def exchanges():
        tops = blocks.localDirsString()
        return {name for top in tops for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}

    before = exchanges()
    table = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert table.count() == 7 and exchanges() - before  # not a staged write: as the session says
    before |= exchanges()
    assert len(stage(table, "counted").collect()) == 7 and spark.conf.get(FREE_SHUFFLES, None) is None
    until = time.time() + 10
    while exchanges() - before and time.time() < until:
        time.sleep(0.1)
    assert not exchanges() - before
