"""The pipeline's tables over one set of test tables, built once per application and input.

Reports run on the transformed trips, as in production: the pipeline writes them once and every
report scans the columns it needs. The tables lie in the workspace and are rebuilt when the source
files change.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.checks.tripview import ID_PARTS, SOURCE_TABLES, trip_view
from tripmill.operators.features import engineer_features
from tripmill.operators.quality import clean_trips
from tripmill.plans.jobs import Transformed, run_transform, transformed_trips
from tripmill.schemas import FINAL_SCHEMA, RAW_SCHEMA
from tripmill.sources.files import scan_parquet, write_partitioned
from tripmill.sources.sizing import enough_partitions, freed_shuffles, setting, stored_files
from tripmill.sources.workspace import workspace


FORCE_SKEW_JOIN = "spark.sql.adaptive.forceOptimizeSkewedJoin"
#: Fast gzip stores the raw trips in 0.37 of their text. It is not cut when it is read, so no file is large: a million
#: trips are about 110 MB of text, less than a default split.
CSV_OPTIONS = {"header": True, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}


class TripTables:
    def __init__(self, spark: SparkSession, sf_dir: str, source_bytes: int):
        self.spark = spark
        self.sf_dir = sf_dir
        self.source_bytes = source_bytes

    @property
    def raw(self) -> DataFrame:
        return trip_view(self.spark, self.sf_dir)

    @cached_property
    def _ingested(self) -> tuple[str, int]:
        path, counted = workspace(self.spark).fresh_path("raw-csv"), Observation()
        rows = self.raw.observe(counted, F.count(F.lit(1)).alias("rows"))
        with enough_partitions(self.spark, self.source_bytes), freed_shuffles(self.spark):
            rows.write.options(**CSV_OPTIONS).csv(path)
        return path, counted.get["rows"]

    @property
    def csv_path(self) -> str:
        return self._ingested[0]

    @property
    def rows_ingested(self) -> int:
        """Counted by the write of the raw trips, not by another scan."""
        return self._ingested[1]

    @cached_property
    def _staged(self) -> tuple[str, int]:
        path = workspace(self.spark).fresh_path("clean")
        trips = trip_view(self.spark, self.sf_dir, parts=True)
        # The dedupe keeps the join's placement; where an order is hot, its split is worth a shuffle after it.
        sized, freed = enough_partitions(self.spark, self.source_bytes), freed_shuffles(self.spark)
        with sized, freed, setting(self.spark, FORCE_SKEW_JOIN, True):
            return path, write_partitioned(clean_trips(trips, ID_PARTS), path)

    @property
    def clean_path(self) -> str:
        return self._staged[0]

    @property
    def rows_staged(self) -> int:
        return self._staged[1]

    @property
    def clean(self) -> DataFrame:
        return scan_parquet(self.spark, self.clean_path, RAW_SCHEMA)

    @cached_property
    def featured_path(self) -> str:
        path = workspace(self.spark).fresh_path("featured")
        engineer_features(self.clean).write.parquet(path)
        return path

    @property
    def featured(self) -> DataFrame:
        return scan_parquet(self.spark, self.featured_path)

    @cached_property
    def _final(self) -> tuple[str, Transformed]:
        path = workspace(self.spark).fresh_path("final")
        return path, run_transform(self.spark, self.clean_path, path, quantiles="exact")

    @property
    def final_path(self) -> str:
        return self._final[0]

    @property
    def transformed(self) -> Transformed:
        return self._final[1]

    @property
    def final(self) -> DataFrame:
        return scan_parquet(self.spark, self.final_path, FINAL_SCHEMA)

    @cached_property
    def _unwritten(self) -> DataFrame:
        return transformed_trips(self.spark, self.clean_path, workspace(self.spark), quantiles="exact")[0]

    @property
    def final_once(self) -> DataFrame:
        """For one pass over few columns: the final trips as written, or, if nothing has written them, lazily."""
        return self.final if "_final" in self.__dict__ else self._unwritten


_TABLES: dict[tuple, TripTables] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Files, bytes and newest change of the source tables; the contents are not read."""
    paths = [f"{sf_dir}/{name}.parquet" for name in SOURCE_TABLES]
    newest = F.unix_micros(F.max("modificationTime"))
    return tuple(stored_files(spark, *paths).agg(F.count(F.lit(1)), F.sum("length"), newest).first())


def trip_tables(spark: SparkSession, sf_dir: str) -> TripTables:
    files = _fingerprint(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, files)
    if key not in _TABLES:
        _TABLES[key] = TripTables(spark, sf_dir, source_bytes=files[1])
    return _TABLES[key]
