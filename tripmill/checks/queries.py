"""One query per operator and report, over the trip view of the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tripmill.checks.tables import TripTables, trip_tables
from tripmill.operators import kpis
from tripmill.operators.features import cast_timestamps, engineer_features, final_columns
from tripmill.operators.metrics import add_borough_metrics, add_borough_trip_rank
from tripmill.operators.outliers import outlier_report, quartile_table, remove_outliers
from tripmill.operators.quality import clean_trips, dedupe, quality_report
from tripmill.plans import jobs
from tripmill.schemas import FINAL_SCHEMA, RAW_SCHEMA
from tripmill.sources import catalog, files
from tripmill.sources.workspace import workspace

MONTH = (1996, 1)
PREVIEW_COLUMNS = ("trip_id", "pickup_borough", "day_of_week", "fare_amount", "tip_percentage")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _zoneless(result: DataFrame) -> DataFrame:
    """Show timestamps without a zone, as the Parquet inputs store them."""
    moments = [f.name for f in result.schema if isinstance(f.dataType, TimestampType)]
    return result.withColumns({name: F.col(name).cast("timestamp_ntz") for name in moments})


def query(build: Callable[[TripTables], DataFrame], name: str | None = None) -> Query:
    """Register ``build`` as a query that runs in UTC on the tables of the given folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The result is lazy and keeps the zone it was analysed in; the session gets its own back.
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            return _zoneless(build(trip_tables(spark, sf_dir)))
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    QUERIES[name or build.__name__] = run
    return run


def _fresh(tables: TripTables, name: str) -> str:
    return workspace(tables.spark).fresh_path(name)


def _fresh_database(tables: TripTables) -> str:
    """An own database whose managed tables lie in the workspace."""
    database = f"tripmill_{uuid.uuid4().hex[:12]}"
    catalog.create_database(
        tables.spark, database, "trip tables of one run", _fresh(tables, database)
    )
    return database


def _registered(tables: TripTables) -> str:
    return catalog.register_table(
        tables.spark, _fresh_database(tables), "taxi_trips", tables.final_path
    ).name


# Sources, sinks, catalog


@query
def scan_csv_schema(t: TripTables) -> DataFrame:
    return files.scan_csv(t.spark, t.csv_path)


@query
def sink_parquet_partitioned(t: TripTables) -> DataFrame:
    path = _fresh(t, "sink")
    files.write_partitioned(t.clean, path, rebalance=False)
    return files.scan_parquet(t.spark, path, RAW_SCHEMA)


@query
def scan_parquet_partitioned(t: TripTables) -> DataFrame:
    return files.scan_parquet(t.spark, t.clean_path)


@query
def catalog_register(t: TripTables) -> DataFrame:
    database = _fresh_database(t)
    current = t.spark.catalog.currentDatabase()
    name = f"{database}.taxi_trips"
    try:
        catalog.use_schema(t.spark, database)
        for _ in range(2):
            catalog.drop_table(t.spark, "taxi_trips")
            catalog.create_external_table(t.spark, "taxi_trips", t.final_path)
        catalog.repair_partitions(t.spark, "taxi_trips")
    finally:
        t.spark.catalog.setCurrentDatabase(current)
    return t.spark.table(name)


@query
def catalog_repair_partitions(t: TripTables) -> DataFrame:
    name = f"{_fresh_database(t)}.taxi_trips"
    catalog.create_external_table(t.spark, name, t.final_path)
    unrepaired = t.spark.table(name).count()
    catalog.repair_partitions(t.spark, name)
    return t.spark.table(name).agg(
        F.lit(unrepaired).cast("long").alias("rows_before_repair"),
        F.count(F.lit(1)).alias("rows_after_repair"),
    )


@query
def catalog_managed_table(t: TripTables) -> DataFrame:
    name = f"{_fresh_database(t)}.taxi_trips"
    catalog.save_managed_table(t.final, name, rebalance=False)
    return t.spark.table(name)


@query
def catalog_show_partitions(t: TripTables) -> DataFrame:
    return catalog.show_partitions(t.spark, _registered(t))


@query
def catalog_describe(t: TripTables) -> DataFrame:
    return catalog.describe_filled(t.spark, _registered(t))


@query
def verify_monthly(t: TripTables) -> DataFrame:
    return catalog.verify_table(t.spark, _registered(t))


@query
def sink_warehouse(t: TripTables) -> DataFrame:
    """The sink with connector options, pointed at Parquet files for want of a warehouse."""
    path = _fresh(t, "warehouse")
    account = {"account": "none", "user": "none", "password": "none", "database": "none"}
    options = {**files.snowflake_options(account), "path": path}
    files.write_warehouse(t.final, "TAXI_TRIPS_CLEAN", options, "parquet")
    return files.scan_parquet(t.spark, path, FINAL_SCHEMA)


@query
def observe_counts(t: TripTables) -> DataFrame:
    """What the writes and the load of the shared tables counted."""
    counts = [
        ("ingested", t.rows_ingested),
        ("staged", t.rows_staged),
        ("loaded", t.transformed.rows_loaded),
        ("written", t.transformed.rows_written),
    ]
    return t.spark.createDataFrame(counts, "step string, step_rows bigint")


@query
def preview(t: TripTables) -> DataFrame:
    return files.preview(t.final, PREVIEW_COLUMNS)


# Data quality


query(lambda t: quality_report(t.raw), "quality_report")
query(lambda t: dedupe(t.raw), "dedupe_trips")
query(lambda t: clean_trips(t.raw), "clean_trips")


# Features


def _feature(name: str, column: str) -> None:
    query(lambda t: engineer_features(t.clean).select("trip_id", column), name)


query(lambda t: cast_timestamps(t.clean), "cast_timestamps")
_feature("feat_duration", "trip_duration_minutes")
_feature("feat_speed", "avg_speed_mph")
_feature("feat_fare_per_mile", "fare_per_mile")
_feature("feat_tip_pct", "tip_percentage")
_feature("feat_hour", "pickup_hour")
_feature("feat_time_of_day", "time_of_day")
_feature("feat_is_weekend", "is_weekend")
_feature("feat_day_name", "day_of_week")
query(lambda t: engineer_features(t.clean), "engineer_features")
query(lambda t: final_columns(add_borough_metrics(t.featured)), "final_columns")


# Outliers and borough metrics


query(lambda t: quartile_table(t.featured), "quartiles")


@query
def quartiles_approx(t: TripTables) -> DataFrame:
    """Per column, the usable rows and whether each sketched quartile keeps its rank bound."""
    trips, checks = t.featured, []
    for name, q1, q3 in quartile_table(t.featured, mode="approx").collect():
        value = F.col(name)
        checks.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(value).alias("usable_rows"),
                *(
                    (
                        (F.count_if(value < quartile) <= F.count(value) * (share + 0.01))
                        & (F.count_if(value <= quartile) >= F.count(value) * (share - 0.01))
                    ).alias(label)
                    for label, quartile, share in (("q1_holds", q1, 0.25), ("q3_holds", q3, 0.75))
                ),
            )
        )
    return trips.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


query(lambda t: remove_outliers(t.featured, ["avg_speed_mph"], "exact"), "iqr_single")
query(lambda t: remove_outliers(t.featured, mode="exact"), "remove_outliers")
query(lambda t: outlier_report(t.featured, mode="exact"), "outlier_report")
query(lambda t: add_borough_metrics(t.featured), "borough_metrics")


@query
def borough_trip_rank(t: TripTables) -> DataFrame:
    ranked = add_borough_trip_rank(t.final)
    return ranked.select("trip_id", "pickup_borough", "fare_amount", "borough_trip_rank")


# Reports


def _report(name: str) -> None:
    query(lambda t: kpis.kpi(t.final, name), name)


for _name in kpis.REPORTS:
    if _name not in ("verify_monthly", "kpi_borough_catalog", "kpi_monthly_catalog"):
        _report(_name)


@query
def kpi_borough_catalog(t: TripTables) -> DataFrame:
    return kpis.kpi(t.spark.table(_registered(t)), "kpi_borough_catalog")


@query
def kpi_monthly_catalog(t: TripTables) -> DataFrame:
    return kpis.kpi(t.spark.table(_registered(t)), "kpi_monthly_catalog")


@query
def count_partition(t: TripTables) -> DataFrame:
    return kpis.count_partition(t.spark.table(_registered(t)), *MONTH, "jan_trips")


query(lambda t: kpis.count_total(t.final), "count_total")
query(lambda t: kpis.anomaly_fare(t.final_once), "anomaly_fare")
query(lambda t: kpis.anomaly_speed(t.final), "anomaly_speed")


# Jobs


def long_form(reports: dict[str, DataFrame]) -> DataFrame:
    """All reports as one table: report, group, measure, value."""
    parts = []
    for name, result in reports.items():
        keys = kpis.REPORTS[name].keys
        measures = [column for column in result.columns if column not in keys]
        group = F.concat_ws("|", *[F.col(key).cast("string") for key in keys])
        doubles = [F.col(column).cast("double").alias(column) for column in measures]
        tall = result.select(group.alias("group_key"), *doubles).unpivot(
            "group_key", measures, "measure", "measured"
        )
        parts.append(tall.select(F.lit(name).alias("report"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query
def serve_kpis(t: TripTables) -> DataFrame:
    return long_form(jobs.run_serve(t.spark, t.final_path))


@query
def job_ingest(t: TripTables) -> DataFrame:
    return jobs.run_ingest(t.spark, t.csv_path, _fresh(t, "job-clean")).clean


@query
def job_transform(t: TripTables) -> DataFrame:
    out = _fresh(t, "job-final")
    return jobs.run_transform(t.spark, t.clean_path, out, quantiles="exact").trips


@query
def job_transform_no_outliers(t: TripTables) -> DataFrame:
    out = _fresh(t, "job-unfenced")
    trips = jobs.run_transform(t.spark, t.clean_path, out, fenced=False).trips
    name = f"{_fresh_database(t)}.taxi_trips"
    catalog.save_managed_table(trips, name, rebalance=False)
    return t.spark.table(name)


@query
def job_register(t: TripTables) -> DataFrame:
    name, _ = jobs.run_register(t.spark, _fresh_database(t), "taxi_trips", t.final_path)
    return t.spark.table(name)


@query
def job_pipeline(t: TripTables) -> DataFrame:
    """The four stages from the raw CSV on; answers with the five served reports."""
    run = jobs.run_pipeline(
        t.spark,
        t.csv_path,
        _fresh(t, "pipeline-clean"),
        _fresh(t, "pipeline-final"),
        _fresh_database(t),
        quantiles="exact",
    )
    return long_form(run.kpis)
