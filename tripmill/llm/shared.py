"""What the operators of this folder share: shipping code, staging tables, text expressions."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tripmill
from tripmill.sources.sizing import FREE_SHUFFLES, setting
from tripmill.sources.workspace import Workspace, workspace

#: The white space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, as a zip of its sources."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(tripmill.__file__))
    archive = os.path.join(tempfile.mkdtemp(), "tripmill_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def stage(table: DataFrame, name: str, space: Workspace | None = None) -> DataFrame:
    """Write the table to the shared folder and read it back: cuts the lineage, survives lost executors.

    Nothing reads the exchanges of the write again, so they are deleted with it. ``space`` holds the table instead
    of the application's workspace; the caller closes it.
    """
    spark = table.sparkSession
    with setting(spark, FREE_SHUFFLES, True):
        return (space or workspace(spark)).stage(table, name)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions, which a deployment sizes by its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII alone take the fast function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once, also where lambdas refer to it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hash128(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes: chance collisions stay out of reach at trillions of rows."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit("second"), *columns).alias("h2")]
