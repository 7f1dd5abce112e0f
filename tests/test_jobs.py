"""Sources, sinks, catalog and the composite jobs, on files."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.test_semantics import trip
from tripmill.checks import queries as check_queries
from tripmill.checks import tables as check_tables
from tripmill.checks.tables import trip_tables
from tripmill.operators import kpis
from tripmill.plans import jobs
from tripmill.schemas import RAW_SCHEMA
from tripmill.sources import catalog, files
from tripmill.sources.workspace import Workspace, shared_root


@pytest.fixture
def month(spark):
    """Trips of one month each, by (id, month)."""
    return lambda *pairs: spark.createDataFrame(
        [trip(trip_id=i, trip_month=m) for i, m in pairs], RAW_SCHEMA
    )


def ids(frame):
    return sorted(row.trip_id for row in frame.collect())


def test_csv_fields_bind_by_position_and_bad_ones_become_null(spark, tmp_path):
    header = ",".join(RAW_SCHEMA.names)
    swapped = header.replace("fare_amount,tip_amount", "tip_amount,fare_amount")
    row = "a,2024-01-08 10:00:00,,Queens,Bronx,x,2.5,10,1,11.5,Cash,2024,1,surplus"
    (tmp_path / "trips.csv").write_text(f"{swapped}\n{row}\n")
    read = files.scan_csv(spark, str(tmp_path)).first()
    assert (read.passenger_count, read.trip_distance_miles, read.fare_amount) == (None, 2.5, 10.0)
    assert read.dropoff_datetime is None and read.trip_month == 1
    with pytest.raises(Exception, match="header"):
        files.scan_csv(spark, str(tmp_path), check_header=True).collect()


def test_static_and_dynamic_overwrite(spark, tmp_path, month):
    path = str(tmp_path / "out")
    assert files.write_partitioned(month(("a", 1), ("b", 2), ("n", None)), path) == 3
    assert ids(files.scan_parquet(spark, path, RAW_SCHEMA).where("trip_month is null")) == ["n"]
    assert files.write_partitioned(month(("c", 2)), path, overwrite="dynamic") == 1
    assert ids(files.scan_parquet(spark, path)) == ["a", "c", "n"]
    files.write_partitioned(month(("d", 3)), path)
    assert ids(files.scan_parquet(spark, path)) == ["d"]
    (written,) = [p.name for p in (tmp_path / "out" / "trip_year=2024" / "trip_month=3").glob("*.parquet")]
    assert written.endswith(".snappy.parquet")


def test_ingest_and_transform_report_their_counts(spark, sf_dir, tmp_path):
    tables = trip_tables(spark, sf_dir)
    staging, out = str(tmp_path / "staging"), str(tmp_path / "out")
    ingested = jobs.run_ingest(spark, tables.csv_path, staging)
    report = ingested.report
    assert report["clean_records"] == ingested.clean.count() == tables.clean.count()
    assert report["total_records"] == report["clean_records"] + report["rejected_records"]
    moved = jobs.run_transform(spark, staging, out)
    assert moved.rows_loaded == report["clean_records"]
    assert moved.rows_written == moved.trips.count()
    with pytest.raises(ValueError):
        jobs.run_transform(spark, staging, staging + "/")
    assert ingested.clean.count() == report["clean_records"]


def test_transform_leaves_no_staged_tables(spark, sf_dir, tmp_path):
    import os

    before = set(os.listdir(shared_root(spark)))
    jobs.run_transform(spark, trip_tables(spark, sf_dir).clean_path, str(tmp_path / "out"))
    assert set(os.listdir(shared_root(spark))) <= before


def test_final_write_needs_no_shuffle(spark, sf_dir):
    """The staged months already place the rows."""
    from tests.test_scale import plan_of
    from tripmill.operators.features import engineer_features, final_columns
    from tripmill.operators.metrics import attach_averages, borough_averages

    featured = engineer_features(trip_tables(spark, sf_dir).clean)
    with Workspace(spark) as space:
        averages = space.stage(borough_averages(featured), "averages")
        plan = plan_of(final_columns(attach_averages(featured, averages)))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_register_is_repeatable_and_keeps_external_files(spark, tmp_path, sf_dir):
    tables = trip_tables(spark, sf_dir)
    rows = tables.final.count()
    for _ in range(2):
        name, monthly = jobs.run_register(spark, "twice", "taxi_trips", tables.final_path)
        assert monthly.agg(F.sum("total_trips")).first()[0] == rows
    kinds = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert kinds["Type"] == "EXTERNAL"
    catalog.drop_table(spark, name)
    assert tables.final.count() == rows
    with pytest.raises(AnalysisException):
        catalog.verify_table(spark, name)


def test_register_surfaces_errors_unless_a_copy_is_asked_for(spark, sf_dir, monkeypatch):
    def refuse(*_):
        raise AnalysisException("no repair here")

    monkeypatch.setattr(catalog, "repair_partitions", refuse)
    tables = trip_tables(spark, sf_dir)
    with pytest.raises(AnalysisException, match="no repair here"):
        catalog.register_table(spark, "fallback", "taxi_trips", tables.final_path)
    made = catalog.register_table(spark, "fallback", "taxi_trips", tables.final_path, managed_fallback=True)
    assert made == catalog.Registered("fallback.taxi_trips", managed=True)
    assert spark.table(made.name).count() == tables.final.count()
    assert catalog.show_partitions(spark, made.name).count() > 1


def test_registration_passes_properties_comments_location_and_codec(spark, sf_dir, tmp_path):
    tables = trip_tables(spark, sf_dir)
    files_at = str(tmp_path / "trips")
    tables.final.limit(50).write.partitionBy("trip_year", "trip_month").parquet(files_at)
    name, _ = jobs.run_register(
        spark, "told", "order", files_at, comment="all trips", properties={"owner team": "data"},
        codec="gzip", database_comment="the trips", database_location=str(tmp_path / "told.db"),
    )
    shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {catalog.quoted(name)}").collect()}
    assert shown["owner team"] == "data" and shown["parquet.compression"] == "GZIP"
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {catalog.quoted(name)}").collect()}
    assert told["Comment"] == "all trips"
    base = {r.info_name: r.info_value for r in spark.sql("DESCRIBE DATABASE EXTENDED told").collect()}
    assert base["Comment"] == "the trips" and base["Location"].endswith("told.db")
    spark.table(catalog.quoted(name)).limit(5).write.insertInto(catalog.quoted(name))
    assert list((tmp_path / "trips").rglob("*.gz.parquet"))


def test_managed_table_of_placed_trips_needs_no_shuffle(spark, sf_dir):
    tables = trip_tables(spark, sf_dir)
    for rebalance in (True, False):
        catalog.save_managed_table(tables.final, "placed_trips", rebalance=rebalance)
        assert spark.table("placed_trips").count() == tables.final.count()
    catalog.drop_table(spark, "placed_trips")


def test_closed_workspace_leaves_nothing(spark, sf_dir):
    import os

    from tripmill.operators.metrics import add_borough_metrics, add_borough_trip_rank

    tables = trip_tables(spark, sf_dir)
    before = set(os.listdir(shared_root(spark)))
    with Workspace(spark) as space:
        assert add_borough_metrics(tables.featured, space).count() == tables.featured.count()
        assert add_borough_trip_rank(tables.final, space).count() == tables.final.count()
        assert set(os.listdir(shared_root(spark))) > before
    assert set(os.listdir(shared_root(spark))) == before


def test_serve_dispatches(spark, sf_dir, tmp_path):
    final = trip_tables(spark, sf_dir).final
    reports = jobs.serve(final)
    assert len(reports) == 5
    total = spark.sql("SELECT count(*) AS n FROM taxi_trips").first().n
    assert reports["kpi_payment_basic"].agg(F.sum("trips")).first()[0] == total
    target = str(tmp_path / "warehouse")
    assert jobs.serve(final, {"path": target}, source_format="parquet") is None
    assert spark.read.parquet(target).count() == total


def test_connector_options():
    settings = {"account": "acme", "user": "u", "password": "p", "database": "d", "role": "r"}
    assert files.snowflake_options(settings) == {
        "sfURL": "acme.snowflakecomputing.com", "sfUser": "u", "sfPassword": "p",
        "sfDatabase": "d", "sfSchema": "PUBLIC", "sfWarehouse": "COMPUTE_WH"}
    chosen = files.snowflake_options({**settings, "schema": "TAXI", "warehouse": "BIG"})
    assert (chosen["sfSchema"], chosen["sfWarehouse"]) == ("TAXI", "BIG")


def test_workspace_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == configured
    assert Workspace(spark).root.startswith(configured)


def test_workspace_without_a_configured_folder():
    """The warehouse's file system, whatever the master is."""

    class Conf:
        def get(self, key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    assert shared_root(Session()) == "hdfs://store/warehouse/_staged"


def test_one_list_needs_no_written_table(spark, sf_dir, monkeypatch):
    """The fare anomalies alone read their columns of the staged trips; once the final table is there, that one."""
    alone = check_tables.TripTables(spark, sf_dir, 1)
    alone.__dict__["_staged"] = trip_tables(spark, sf_dir)._staged
    monkeypatch.setattr(check_queries, "trip_tables", lambda *_: alone)
    found = check_queries.QUERIES["anomaly_fare"](spark, sf_dir)
    assert "_final" not in alone.__dict__
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "tip_amount" not in plan and "day_of_week" not in plan
    rows = found.collect()
    assert rows and rows == kpis.anomaly_fare(alone.final).collect()
    assert check_queries.QUERIES["anomaly_fare"](spark, sf_dir).collect() == rows
    assert alone.final_once.inputFiles()[0].startswith("file:") and alone.final_path in alone.final_once.inputFiles()[0]
