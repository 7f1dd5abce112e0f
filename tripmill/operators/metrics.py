"""Borough averages and fare rank.

A window over the borough would send all rows of a borough to one task. Both operators instead
shuffle pre-aggregated rows and join them back. The aggregate is staged, so the planner knows its
size: it broadcasts a small one and otherwise runs a sort-merge join whose hot keys adaptive
execution splits. The join is null-safe, because a window treats null boroughs as one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmill.functions.sums import exact_mean
from tripmill.sources.workspace import Workspace, workspace


def borough_averages(trips: DataFrame) -> DataFrame:
    """One row per pickup borough with its rounded mean fare and distance."""
    return trips.groupBy("pickup_borough").agg(
        F.round(exact_mean("fare_amount"), 2).alias("borough_avg_fare"),
        F.round(exact_mean("trip_distance_miles"), 2).alias("borough_avg_distance"),
    )


def _attach(trips: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Add the non-key columns of ``facts``, matching null keys too; every trip is kept."""
    renamed = facts.withColumnsRenamed({key: f"fact_{key}" for key in keys})
    matches = [F.col(key).eqNullSafe(F.col(f"fact_{key}")) for key in keys]
    return trips.join(renamed, matches, "left").drop(*(f"fact_{key}" for key in keys))


def attach_averages(trips: DataFrame, averages: DataFrame) -> DataFrame:
    """Append the averages and the fare's difference to the rounded mean."""
    return _attach(trips, averages, ["pickup_borough"]).withColumn(
        "fare_vs_borough_avg", F.round(F.col("fare_amount") - F.col("borough_avg_fare"), 2)
    )


def add_borough_metrics(trips: DataFrame, space: Workspace | None = None) -> DataFrame:
    """``space`` holds the staged averages; the caller's own can be closed when the result is read."""
    space = space or workspace(trips.sparkSession)
    averages = space.stage(borough_averages(trips), "borough-averages")
    return attach_averages(trips, averages)


def add_borough_trip_rank(trips: DataFrame, space: Workspace | None = None) -> DataFrame:
    """Append ``borough_trip_rank``: rank of the fare in its borough, highest first, nulls last.

    A fare's rank is one plus the number of higher fares. Equal fares are counted first, so a hot
    fare is one row; the counts are range-partitioned into slices by borough and falling fare, and a
    rank is the total of the borough's earlier slices plus the running total inside the slice. The
    slice number is staged with the counts, so both totals see the same slices.
    """
    space = space or workspace(trips.sparkSession)
    counts = trips.groupBy("pickup_borough", "fare_amount").agg(F.count(F.lit(1)).alias("trips"))
    falling = F.col("fare_amount").desc_nulls_last()
    sliced = space.stage(
        counts.repartitionByRange(F.col("pickup_borough"), falling).withColumn(
            "slice", F.spark_partition_id()
        ),
        "fare-counts",
    )

    earlier = Window.partitionBy("pickup_borough").orderBy("slice")
    offsets = (
        sliced.groupBy("pickup_borough", "slice")
        .agg(F.sum("trips").alias("slice_trips"))
        .withColumn("before_slice", F.sum("slice_trips").over(earlier) - F.col("slice_trips"))
        .drop("slice_trips")
    )
    within = Window.partitionBy("pickup_borough", "slice").orderBy(falling)
    running = sliced.withColumn("before_fare", F.sum("trips").over(within) - F.col("trips"))
    ranks = _attach(running, offsets, ["pickup_borough", "slice"]).select(
        "pickup_borough",
        "fare_amount",
        (F.col("before_slice") + F.col("before_fare") + 1).alias("borough_trip_rank"),
    )
    staged = space.stage(ranks, "fare-ranks")
    return _attach(trips, staged, ["pickup_borough", "fare_amount"])
