"""Task sizes that do not grow with the input, and the disk that actions leave.

Adaptive execution merges small shuffle partitions, but cuts only skewed ones, so their number must follow the
bytes that are shuffled; and a write into month folders sorts whatever one task has scanned. Both limits hold for
the actions inside the block only, and never undercut a session that asks for smaller tasks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
#: Spark deletes the shuffle files of an action at its end, not when the driver next collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stored bytes for each shuffle partition: packed Parquet grows about twenty times as rows, plain CSV about three
#: times. Gzipped CSV is shuffled in up to about twice its bytes, so a unit of it stays below the default advisory size.
PARQUET_BYTES = 4 << 20
CSV_BYTES = 24 << 20
#: Parquet that one task of an unshuffled write scans and sorts.
WRITE_SPLIT_BYTES = 48 << 20
#: Packed CSV that one task scans, about a default split when unpacked. Most packed files are not cut, so it takes whole ones.
PACKED_SPLIT_BYTES = 24 << 20
PACKED = r"\.(bz2|deflate|gz|lz4|snappy|zst)$"


def stored_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Path, length and modification time of the files; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.select("path", "length", "modificationTime")


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    return stored_files(spark, *paths).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def _bytes(text: str) -> int:
    """The bytes of a size such as 134217728, 134217728b, 16m or 1GB."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def setting(spark: SparkSession, name: str, value: int | bool) -> Iterator[None]:
    earlier = spark.conf.get(name, None)
    spark.conf.set(name, str(value).lower())
    try:
        yield
    finally:
        if earlier is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, earlier)


@contextmanager
def enough_partitions(spark: SparkSession, size: int, unit: int = PARQUET_BYTES) -> Iterator[None]:
    """At least one shuffle partition for each ``unit`` of the ``size`` bytes; adaptive execution merges small ones."""
    planned = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    with setting(spark, INITIAL_PARTITIONS, max(planned, math.ceil(size / unit))):
        yield


@contextmanager
def small_splits(spark: SparkSession, limit: int | None = None) -> Iterator[None]:
    """Scans in splits of at most ``limit``, or else ``WRITE_SPLIT_BYTES``."""
    with setting(spark, SPLIT_BYTES, min(_bytes(spark.conf.get(SPLIT_BYTES)), limit or WRITE_SPLIT_BYTES)):
        yield


@contextmanager
def packed_splits(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Scans in splits of at most ``PACKED_SPLIT_BYTES`` if a file is packed; plain files keep the session's."""
    packed = stored_files(spark, *paths).where(F.col("path").rlike(PACKED)).limit(1).count()
    with small_splits(spark, PACKED_SPLIT_BYTES) if packed else nullcontext():
        yield


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each action deletes its exchanges at its end: for results whose plan no later action runs again."""
    with setting(spark, FREE_SHUFFLES, True):
        yield
