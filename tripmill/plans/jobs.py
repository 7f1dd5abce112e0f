"""Composite jobs: ingest, transform, register, serve, and all four in a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.features import engineer_features, final_columns
from tripmill.operators.kpis import SERVED_REPORTS, kpi
from tripmill.operators.metrics import attach_averages, borough_averages
from tripmill.operators.outliers import FENCE_COLUMNS, Fence, apply_fences, compute_fences
from tripmill.operators.quality import clean_trips, raw_counts
from tripmill.schemas import FINAL_SCHEMA, RAW_SCHEMA
from tripmill.sources import catalog
from tripmill.sources.files import (
    SNOWFLAKE_FORMAT,
    scan_csv,
    scan_parquet,
    write_partitioned,
    write_warehouse,
)
from tripmill.sources.sizing import CSV_BYTES, enough_partitions, freed_shuffles, packed_splits, stored_bytes
from tripmill.sources.workspace import Workspace


@dataclass(frozen=True)
class Ingested:
    """``clean`` scans the staged table; ``report`` holds the quality counts."""

    clean: DataFrame
    report: dict[str, int]


@dataclass(frozen=True)
class Transformed:
    """``trips`` scans the written table."""

    trips: DataFrame
    fences: list[Fence]
    rows_loaded: int
    rows_written: int


def run_ingest(spark: SparkSession, csv_path: str, staging_path: str) -> Ingested:
    """Count the raw rows, write the clean ones by month: one aggregate and one write.

    The number of shuffle partitions follows the size of the files, so no task grows with them, and the exchange of
    the count is gone before the write makes its own.
    """
    raw = scan_csv(spark, csv_path)
    with freed_shuffles(spark), packed_splits(spark, csv_path):
        with enough_partitions(spark, stored_bytes(spark, csv_path), CSV_BYTES):
            report = raw_counts(raw).first().asDict()
            report["clean_records"] = write_partitioned(clean_trips(raw), staging_path)
    report["rejected_records"] = report["total_records"] - report["clean_records"]
    return Ingested(scan_parquet(spark, staging_path, RAW_SCHEMA), report)


def run_transform(
    spark: SparkSession,
    staging_path: str,
    output_path: str,
    fenced: bool = True,
    quantiles: str = "approx",
) -> Transformed:
    """Staged trips to featured trips with borough metrics, written by month.

    The fences and averages need several passes over five columns, so exactly those are staged
    first, with the datetimes already parsed. The last pass reads the staged trips once more,
    applies the bounds as literals, joins the averages and writes. The trips already lie in month
    folders, so that write needs no shuffle and makes no more files than the scan has splits.
    Without fences (``fenced=False``) all rows and all columns are kept.

    The bounds of stored columns reach that pass's scan; those of duration and speed stay above the
    features. The loaded rows are those that reached the first fence.
    """
    if output_path.rstrip("/") == staging_path.rstrip("/"):
        raise ValueError("the output must not overwrite the staged trips it is read from")
    with Workspace(spark) as space:
        trips, fences = transformed_trips(spark, staging_path, space, fenced, quantiles)
        rows_written = write_partitioned(trips, output_path, rebalance=False)

    written = scan_parquet(spark, output_path, trips.schema)
    rows_loaded = fences[0].rows_before if fences else rows_written
    return Transformed(written, fences, rows_loaded, rows_written)


def transformed_trips(
    spark: SparkSession, staging_path: str, space: Workspace, fenced: bool = True, quantiles: str = "approx"
) -> tuple[DataFrame, list[Fence]]:
    """The transformed trips as a lazy scan of the staged ones, and their fences, for which the passes are run.

    A single report reads only its own columns of it. ``space`` holds the staged averages that the scan joins.
    """
    staged = scan_parquet(spark, staging_path, RAW_SCHEMA)
    featured = engineer_features(staged)
    if fenced:
        measures = space.stage(featured.select("pickup_borough", *FENCE_COLUMNS), "measures")
        fences = compute_fences(measures, mode=quantiles)
        source = apply_fences(measures, fences)
    else:
        fences, source = [], featured
    averages = space.stage(borough_averages(source), "borough-averages")
    trips = attach_averages(fenced_features(staged, fences), averages)
    return final_columns(trips) if fenced else trips, fences


def fenced_features(staged: DataFrame, fences: Sequence[Fence]) -> DataFrame:
    """Featured trips inside the fences.

    The observation is a barrier: below it, a comparison of a feature would parse the datetimes again.
    Nothing reads its count.
    """
    stored = [fence for fence in fences if fence.column in staged.columns]
    derived = [fence for fence in fences if fence.column not in staged.columns]
    featured = engineer_features(apply_fences(staged, stored))
    if derived:
        featured = featured.observe(Observation(), F.count(F.lit(1)).alias("rows"))
    return apply_fences(featured, derived)


def run_register(
    spark: SparkSession, database: str, table: str, location: str, **options
) -> tuple[str, DataFrame]:
    """Register the written trips; returns the table's name and its monthly verification.

    ``options`` are those of ``register_table``: comment, properties, codec, database location, fallback.
    """
    name = catalog.register_table(spark, database, table, location, **options).name
    return name, catalog.verify_table(spark, name)


def serve(
    trips: DataFrame,
    warehouse: Mapping[str, str] | None = None,
    table: str = "TAXI_TRIPS_CLEAN",
    source_format: str = SNOWFLAKE_FORMAT,
    view: str = "taxi_trips",
) -> dict[str, DataFrame] | None:
    """Without warehouse options, offer the view to SQL and answer the five reports lazily;
    with them, only write the trips to the warehouse table."""
    if warehouse is not None:
        write_warehouse(trips, table, warehouse, source_format)
        return None
    trips.createOrReplaceTempView(view)
    viewed = trips.sparkSession.table(view)
    return {name: kpi(viewed, name) for name in SERVED_REPORTS}


def run_serve(
    spark: SparkSession, trips_path: str, warehouse: Mapping[str, str] | None = None, **sink: str
) -> dict[str, DataFrame] | None:
    return serve(scan_parquet(spark, trips_path, FINAL_SCHEMA), warehouse, **sink)


@dataclass(frozen=True)
class PipelineRun:
    report: dict[str, int]
    transformed: Transformed
    table: str
    monthly: DataFrame
    kpis: dict[str, DataFrame] | None


def run_pipeline(
    spark: SparkSession,
    csv_path: str,
    staging_path: str,
    output_path: str,
    database: str,
    table: str = "taxi_trips",
    warehouse: Mapping[str, str] | None = None,
    quantiles: str = "approx",
) -> PipelineRun:
    ingested = run_ingest(spark, csv_path, staging_path)
    transformed = run_transform(spark, staging_path, output_path, quantiles=quantiles)
    name, monthly = run_register(spark, database, table, output_path)
    kpis = run_serve(spark, output_path, warehouse)
    return PipelineRun(ingested.report, transformed, name, monthly, kpis)
