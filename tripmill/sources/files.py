"""File scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.schemas import PARTITION_COLUMNS, RAW_SCHEMA
from tripmill.sources.sizing import small_splits

# Fixed value: the data source name of the public warehouse connector.
SNOWFLAKE_FORMAT = "net.snowflake.spark.snowflake"


def scan_csv(
    spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, check_header: bool = False
) -> DataFrame:
    """Scan headed CSV files under a fixed schema.

    A field that does not parse becomes null. Columns bind by position; ``check_header`` makes a
    header that disagrees with the schema an error instead.
    """
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    return reader.option("enforceSchema", not check_header).csv(path)


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan Parquet with its partition folders; a schema fixes the partition column types."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_partitioned(
    trips: DataFrame,
    path: str,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    rebalance: bool = True,
    overwrite: str = "static",
) -> int:
    """Overwrite ``path`` with Parquet in year/month folders and return the rows written.

    ``static`` replaces the whole target, ``dynamic`` only the partitions present in ``trips``.
    ``rebalance`` gathers each month in few files; adaptive execution splits a hot month over many
    tasks. Turn it off when the input is already laid out by month: the write then needs no shuffle,
    and scans in small splits, because each task sorts by month what it has scanned.
    The rows are counted by an observation in the write's own last stage, where Spark counts each
    task once even if it is retried.
    """
    counted = Observation()
    placed = trips.hint("rebalance", *partition_by) if rebalance else trips
    placed = placed.observe(counted, F.count(F.lit(1)).alias("rows"))
    with nullcontext() if rebalance else small_splits(trips.sparkSession):
        (
            placed.write.mode("overwrite")
            .option("compression", "snappy")
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(*partition_by)
            .parquet(path)
        )
    return counted.get["rows"]


def snowflake_options(settings: Mapping[str, str]) -> dict[str, str]:
    """Connector options from account settings; the connector's option names are fixed values."""
    return {
        "sfURL": settings["account"] + ".snowflakecomputing.com",
        "sfUser": settings["user"],
        "sfPassword": settings["password"],
        "sfDatabase": settings["database"],
        "sfSchema": settings.get("schema", "PUBLIC"),
        "sfWarehouse": settings.get("warehouse", "COMPUTE_WH"),
    }


def write_warehouse(
    trips: DataFrame,
    table: str,
    options: Mapping[str, str],
    source_format: str = SNOWFLAKE_FORMAT,
) -> None:
    """Overwrite a table of an external warehouse through any Spark data source."""
    writer = trips.write.format(source_format).options(**options).option("dbtable", table)
    writer.mode("overwrite").save()


def preview(
    trips: DataFrame, columns: Sequence[str], rows: int = 10, key: str = "trip_id"
) -> DataFrame:
    """The first rows in key order, so that every run shows the same ones."""
    return trips.select(*columns).orderBy(key, *(c for c in columns if c != key)).limit(rows)
