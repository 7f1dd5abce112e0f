"""Catalog operators: databases, external and managed trip tables, partitions, verification.

Tables use data-source DDL, which works in the in-memory catalog and in a metastore alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.operators.kpis import kpi
from tripmill.schemas import FINAL_SCHEMA, PARTITION_COLUMNS
from tripmill.sources.sizing import small_splits


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """A one- or two-part name with each part quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split(".", 1))


@dataclass(frozen=True)
class Registered:
    """A registered table and whether it is a managed copy of the files."""

    name: str
    managed: bool


def create_database(
    spark: SparkSession, database: str, comment: str | None = None, location: str | None = None
) -> None:
    statement = f"CREATE DATABASE IF NOT EXISTS {quoted(database)}"
    if comment:
        statement += f" COMMENT {_text(comment)}"
    if location:
        statement += f" LOCATION {_text(location)}"
    spark.sql(statement)


def use_schema(spark: SparkSession, schema: str) -> None:
    """Create the schema if absent and make it the current one."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(schema)}")
    spark.catalog.setCurrentDatabase(schema)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop the table if present; the files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")


def create_external_table(
    spark: SparkSession,
    table: str,
    location: str,
    schema: StructType = FINAL_SCHEMA,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    properties: Mapping[str, str] | None = None,
    comment: str | None = None,
    codec: str = "snappy",
) -> None:
    """Declare a partitioned Parquet table over existing files. It is empty until repaired.

    ``codec`` compresses later inserts; the table property of that name only shows it.
    """
    columns = []
    for column in schema:
        told = column.metadata.get("comment")
        remark = f" COMMENT {_text(told)}" if told else ""
        columns.append(f"{quoted(column.name)} {column.dataType.simpleString()}{remark}")
    shown = {"parquet.compression": codec.upper(), **(properties or {})}
    pairs = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in shown.items())
    remark = f"COMMENT {_text(comment)} " if comment else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({', '.join(columns)}) USING parquet "
        f"OPTIONS (compression {_text(codec)}) "
        f"PARTITIONED BY ({', '.join(map(quoted, partition_by))}) LOCATION {_text(location)} {remark}"
        f"TBLPROPERTIES ({pairs})"
    )


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register the partition folders found on storage."""
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")


def save_managed_table(
    trips: DataFrame,
    table: str,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    rebalance: bool = True,
) -> None:
    """Overwrite a managed table, partitioned like the files it replaces.

    Turn ``rebalance`` off for trips that are already laid out by month: no shuffle then, and small splits.
    """
    placed = trips.hint("rebalance", *partition_by) if rebalance else trips
    writer = placed.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    with nullcontext() if rebalance else small_splits(trips.sparkSession):
        writer.saveAsTable(quoted(table))


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    codec: str = "snappy",
    database_comment: str | None = None,
    database_location: str | None = None,
    managed_fallback: bool = False,
) -> Registered:
    """(Re)create an external table over the files and find its partitions.

    An error of the repair surfaces. With ``managed_fallback`` the files are copied to a managed table
    instead, for catalogs that cannot repair partitions; the result tells which table was made.
    """
    name = f"{database}.{table}"
    create_database(spark, database, database_comment, database_location)
    drop_table(spark, name)
    create_external_table(
        spark, name, location, properties=properties, comment=comment, codec=codec
    )
    try:
        repair_partitions(spark, name)
    except AnalysisException:
        if not managed_fallback:
            raise
        drop_table(spark, name)
        trips = spark.read.schema(FINAL_SCHEMA).parquet(location)
        save_managed_table(trips, name, rebalance=False)
        return Registered(name, managed=True)
    return Registered(name, managed=False)


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {quoted(table)}")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {quoted(table)}")


def describe_filled(spark: SparkSession, table: str) -> DataFrame:
    """The described columns with how many rows of the table have a value: one aggregate."""
    rows = spark.table(table)
    counts = rows.agg(*(F.count(name).alias(name) for name in rows.columns)).unpivot(
        [], rows.columns, "col_name", "filled_rows"
    )
    columns = describe(spark, table).where(F.col("data_type").isin(*(t for _, t in rows.dtypes)))
    return columns.distinct().join(counts, "col_name").select("col_name", "data_type", "comment", "filled_rows")


def verify_table(spark: SparkSession, table: str) -> DataFrame:
    """Monthly trips, mean fare and mean distance of a registered table."""
    return kpi(spark.table(table), "verify_monthly")
