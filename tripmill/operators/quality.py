"""Data quality: report, deterministic dedupe, valid-row filter.

``dedupe`` keeps the first row of each id in a total order over all other columns (nulls last),
so the survivor does not depend on the physical layout. The rank-one filter makes Spark prune each
map task to one row per id before the shuffle, so a hot id costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmill.sources.workspace import Workspace, workspace

CRITICAL_COLUMNS = ("trip_id", "pickup_datetime", "fare_amount", "trip_distance_miles")


def _survivor_order(trips: DataFrame, keys: Sequence[str]) -> list[Column]:
    """All other columns ascending, nulls last: what comes first survives.

    Each column follows its null flag, so that a sort and a struct comparison agree.
    """
    others = [name for name in trips.columns if name not in keys]
    return [part for name in others for part in (F.col(name).isNull().alias(f"no_{name}"), F.col(name))]


def dedupe(trips: DataFrame, key: str = "trip_id", parts: Sequence[str] = ()) -> DataFrame:
    """One row per key; rows without a key collapse to one.

    ``parts`` are columns that the key determines and is made of. They lead the sort, and trips that are already
    placed by one of them need no shuffle.
    """
    keys = (*parts, key)
    order = Window.partitionBy(*keys).orderBy(*_survivor_order(trips, keys))
    ranked = trips.withColumn("survivor_rank", F.row_number().over(order))
    return ranked.where(F.col("survivor_rank") == 1).drop("survivor_rank")


def is_valid() -> Column:
    """Positive fare and distance. NaN counts as positive, null does not pass."""
    return (F.col("fare_amount") > 0) & (F.col("trip_distance_miles") > 0)


def clean_trips(trips: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """Dedupe, then keep valid rows with an id.

    The validity test must follow the dedupe, or an invalid survivor would be replaced by a valid
    copy. The id test may go first: rows without an id only compete with each other. The ``parts`` of the id
    (see ``dedupe``) are dropped.
    """
    return dedupe(trips.where(F.col("trip_id").isNotNull()), parts=parts).where(is_valid()).drop(*parts)


def _row_counts() -> list[Column]:
    nulls = [
        F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in CRITICAL_COLUMNS
    ]
    return [
        F.count(F.lit(1)).alias("total_records"),
        *nulls,
        F.count_if(F.col("fare_amount") <= 0).alias("invalid_fare"),
        F.count_if(F.col("trip_distance_miles") <= 0).alias("invalid_distance"),
    ]


def raw_counts(trips: DataFrame) -> DataFrame:
    """One row: totals, nulls, bad ranges and duplicates, without the cleaning result.

    A single distinct count next to plain counts needs one shuffle, on the id.
    """
    counted = trips.agg(*_row_counts(), F.count_distinct("trip_id").alias("distinct_ids"))
    ids = F.col("distinct_ids") + (F.col("null_trip_id") > 0).cast("long")
    return counted.withColumn("duplicate_ids", F.col("total_records") - ids).drop("distinct_ids")


def quality_report(trips: DataFrame, space: Workspace | None = None) -> DataFrame:
    """The whole report in one row.

    Grouping by id yields the counts and the number of distinct ids. An id whose rows are all valid, or
    none, needs no survivor to tell whether it is kept; only the rows of ids with both kinds are deduped.
    ``space`` holds the staged counts; the caller's own can be closed when the report is read.
    """
    space = space or workspace(trips.sparkSession)
    valid = F.count_if(is_valid())
    per_id = space.stage(trips.groupBy("trip_id").agg(*_row_counts(), valid.alias("valid")), "id-counts")
    has_id = F.col("trip_id").isNotNull()
    sums = [
        F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name)
        for name in (
            "total_records",
            *(f"null_{column}" for column in CRITICAL_COLUMNS),
            "invalid_fare",
            "invalid_distance",
        )
    ]
    counted = per_id.agg(
        *sums,
        F.count(F.lit(1)).alias("ids"),
        F.count_if(has_id & (F.col("valid") == F.col("total_records"))).alias("clean_records"),
    )
    mixed = space.stage(
        per_id.where(has_id & (F.col("valid") > 0) & (F.col("valid") < F.col("total_records"))).select("trip_id"),
        "mixed-ids",
    )
    survivors = dedupe(trips.join(mixed, "trip_id", "left_semi")).agg(
        *(F.lit(0).cast("long").alias(name) for name in counted.columns if name != "clean_records"),
        F.count_if(is_valid()).alias("clean_records"),
    )
    report = counted.unionByName(survivors).agg(*(F.sum(name).alias(name) for name in counted.columns))
    return report.select(
        *[column for column in report.columns if column not in ("ids", "clean_records")],
        (F.col("total_records") - F.col("ids")).alias("duplicate_ids"),
        "clean_records",
        (F.col("total_records") - F.col("clean_records")).alias("rejected_records"),
    )
