"""Tasks that do not grow with the input: shuffle partitions and splits."""

import gzip
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.test_scale import bag, plan_of
from tripmill.checks import tables as check_tables
from tripmill.checks.tripview import ID_PARTS, SOURCE_TABLES, trip_view
from tripmill.operators import quality
from tripmill.plans import jobs
from tripmill.sources import catalog, files, sizing


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return check_tables.trip_tables(spark, sf_dir)


def partitions_of(frame):
    return int(re.search(r"hashpartitioning\(.*?, (\d+)\)", plan_of(frame)).group(1))


def test_partitions_follow_the_bytes(spark):
    counted = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count
    before = partitions_of(counted())
    with sizing.enough_partitions(spark, 100 * sizing.PARQUET_BYTES + 1):
        assert partitions_of(counted()) == 101
    with sizing.enough_partitions(spark, 1):
        assert partitions_of(counted()) == before
    with pytest.raises(ZeroDivisionError), sizing.enough_partitions(spark, 100 * sizing.PARQUET_BYTES):
        raise ZeroDivisionError
    assert partitions_of(counted()) == before and spark.conf.get(sizing.INITIAL_PARTITIONS, None) is None


def test_shared_tables_size_their_shuffles(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(check_tables, "write_partitioned", lambda trips, path: seen.append(partitions_of(trips)) or 0)
    check_tables.TripTables(spark, sf_dir, 40 * sizing.PARQUET_BYTES).rows_staged
    assert seen == [40]


@pytest.fixture
def unbroadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    with sizing.setting(spark, names[0], -1), sizing.setting(spark, names[1], -1):
        yield


def test_staged_trips_are_deduped_where_the_join_placed_them(spark, sf_dir, unbroadcast, monkeypatch):
    seen = []
    monkeypatch.setattr(check_tables, "write_partitioned", lambda trips, path: seen.append(plan_of(trips)) or 0)
    check_tables.TripTables(spark, sf_dir, 1).rows_staged
    assert "Window [" in seen[0] and "SortMergeJoin [l_orderkey" in seen[0]
    # Neither by the id nor by its parts.
    assert not re.search(r"Exchange hashpartitioning\((trip_id|l_orderkey#\w+, l_linenumber)", seen[0])
    assert spark.conf.get(check_tables.FORCE_SKEW_JOIN) == "false"


def test_dedupe_by_parts_with_a_hot_order_and_null_lines(spark, sf_dir, unbroadcast, tmp_path):
    for name in SOURCE_TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "lineitem":
            line = F.col("l_linenumber")
            hot = F.when(F.col("l_partkey") % 3 > 0, table.agg(F.min("l_orderkey")).first()[0]).otherwise(F.col("l_orderkey"))
            table = table.withColumn("l_orderkey", hot).withColumn("l_linenumber", F.when(line != 2, line)).repartition(8)
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    expected = bag(quality.clean_trips(trip_view(spark, str(tmp_path))))
    skew, none = "spark.sql.adaptive.skewJoin.skewedPartition", "spark.sql.adaptive.coalescePartitions.enabled"
    with (
        sizing.setting(spark, f"{skew}ThresholdInBytes", 1000),
        sizing.setting(spark, f"{skew}Factor", 2),
        sizing.setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", 4000),
        sizing.setting(spark, none, False),
        sizing.setting(spark, check_tables.FORCE_SKEW_JOIN, True),
    ):
        clean = quality.clean_trips(trip_view(spark, str(tmp_path), parts=True), ID_PARTS)
        rows = clean.collect()
        plan = plan_of(clean)
    assert sum(expected.values()) == len(rows) and bag(spark.createDataFrame(rows, clean.schema)) == expected
    assert "skew=true" in plan  # a hot order does not stay in one task


def test_staged_trips_equal_those_deduped_by_id(tables):
    assert bag(tables.clean) == bag(quality.clean_trips(tables.raw))


def test_ingest_sizes_its_shuffles(spark, tables, tmp_path, monkeypatch):
    seen = []

    def spy(trips, path, *args, **options):
        seen.append(partitions_of(trips))
        return files.write_partitioned(trips, path, *args, **options)

    size = sizing.stored_bytes(spark, tables.csv_path)
    monkeypatch.setattr(jobs, "write_partitioned", spy)
    monkeypatch.setattr(jobs, "CSV_BYTES", size // 30)
    ingested = jobs.run_ingest(spark, tables.csv_path, str(tmp_path / "clean"))
    assert bag(ingested.clean) == bag(tables.clean)
    assert len(seen) == 1 and seen[0] in (30, 31)


@pytest.mark.parametrize("text, size", [("134217728b", 1 << 27), ("16m", 1 << 24), ("2 GB", 2 << 30), ("77", 77)])
def test_sizes_as_sessions_write_them(text, size):
    assert sizing._bytes(text) == size


def test_unshuffled_writes_scan_small_splits(spark, tables, tmp_path, monkeypatch):
    """A task sorts what it has scanned, so the split bounds its memory."""
    source = str(tmp_path / "source")
    tables.clean.coalesce(1).write.option("parquet.block.size", 32 << 10).parquet(source)
    trips = spark.read.parquet(source)
    monkeypatch.setattr(sizing, "WRITE_SPLIT_BYTES", 64 << 10)
    files.write_partitioned(trips, str(tmp_path / "sink"), rebalance=False)
    catalog.save_managed_table(trips, "default.split_check", rebalance=False)
    written = spark.read.parquet(str(tmp_path / "sink"))
    assert bag(written) == bag(trips) == bag(spark.table("default.split_check"))
    # A month that lies in one file of the source is written by each task that scans a part of it.
    parts = {re.search(r"part-(\d+)", path).group(1) for path in written.inputFiles()}
    copies = {re.search(r"part-(\d+)", path).group(1) for path in spark.table("default.split_check").inputFiles()}
    assert len(parts) > 1 and len(copies) > 1
    assert spark.conf.get(sizing.SPLIT_BYTES) == "134217728b"


@pytest.fixture
def new_exchanges(spark):
    """Shuffle files that were not there before the test; waits for those that Spark is about to delete."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def exchanges():
        tops = blocks.localDirsString()
        return {name for top in tops for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}

    before = exchanges()

    def left():
        until = time.time() + 10
        while exchanges() - before and time.time() < until:
            time.sleep(0.1)
        return exchanges() - before

    return left


def test_ingest_deletes_its_exchanges(spark, tables, tmp_path, monkeypatch, new_exchanges):
    seen = []

    def spy(trips, path, *args, **options):
        seen.append(new_exchanges())
        return files.write_partitioned(trips, path, *args, **options)

    monkeypatch.setattr(jobs, "write_partitioned", spy)
    ingested = jobs.run_ingest(spark, tables.csv_path, str(tmp_path / "clean"))
    assert seen == [set()]  # that of the count, before the write makes its own
    assert not new_exchanges() and bag(ingested.clean) == bag(tables.clean)
    assert spark.conf.get(sizing.FREE_SHUFFLES, None) is None


def test_shared_builds_delete_their_exchanges(spark, sf_dir, unbroadcast, new_exchanges):
    built = check_tables.TripTables(spark, sf_dir, 1)
    assert built.rows_ingested and built.rows_staged and not new_exchanges()


def test_raw_csv_is_stored_packed_in_small_files(spark, sf_dir, tables, monkeypatch):
    monkeypatch.setitem(check_tables.CSV_OPTIONS, "maxRecordsPerFile", 500)
    built = check_tables.TripTables(spark, sf_dir, 1)
    paths = [row.path.removeprefix("file:") for row in sizing.stored_files(spark, built.csv_path).collect()]
    texts = [gzip.open(path, "rb").read() for path in paths if path.endswith(".csv.gz")]
    assert len(texts) > 1 and max(text.count(b"\n") for text in texts) == 501
    assert sizing.stored_bytes(spark, built.csv_path) < 0.5 * sum(map(len, texts))
    assert bag(files.scan_csv(spark, built.csv_path)) == bag(built.raw)
    assert built.rows_ingested == built.raw.count() == sum(text.count(b"\n") - 1 for text in texts)


@pytest.mark.parametrize("packed", [True, False])
def test_ingest_scans_packed_files_in_small_splits(spark, tables, tmp_path, monkeypatch, packed):
    """A file that cannot be cut is one task; small ones are not gathered into a task that unpacks much more."""
    source = str(tmp_path / "csv")
    rows = files.scan_csv(spark, tables.csv_path).repartition(12)
    rows.write.option("header", True).option("compression", "gzip" if packed else "none").csv(source)
    seen = []

    def spy(trips, path, *args, **options):
        seen.append(files.scan_csv(spark, source).rdd.getNumPartitions())
        return files.write_partitioned(trips, path, *args, **options)

    monkeypatch.setattr(jobs, "write_partitioned", spy)
    monkeypatch.setattr(sizing, "PACKED_SPLIT_BYTES", 1 << 10)
    monkeypatch.setattr(sizing, "WRITE_SPLIT_BYTES", 1 << 10)
    with sizing.setting(spark, "spark.sql.files.openCostInBytes", 0), sizing.setting(spark, "spark.sql.files.minPartitionNum", 2):
        outside = files.scan_csv(spark, source).rdd.getNumPartitions()
        ingested = jobs.run_ingest(spark, source, str(tmp_path / "clean"))
    assert seen == [12 if packed else outside] and outside < 12
    assert bag(ingested.clean) == bag(tables.clean)
