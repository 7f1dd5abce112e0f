"""Fixed schemas and column lists of the trip tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PARTITION_COLUMNS = ("trip_year", "trip_month")

# The thirteen raw columns, in file order.
RAW_SCHEMA = StructType(
    [
        StructField("trip_id", StringType()),
        StructField("pickup_datetime", StringType()),
        StructField("dropoff_datetime", StringType()),
        StructField("pickup_borough", StringType()),
        StructField("dropoff_borough", StringType()),
        StructField("passenger_count", IntegerType()),
        StructField("trip_distance_miles", DoubleType()),
        StructField("fare_amount", DoubleType()),
        StructField("tip_amount", DoubleType()),
        StructField("total_amount", DoubleType()),
        StructField("payment_type", StringType()),
        StructField("trip_year", IntegerType()),
        StructField("trip_month", IntegerType()),
    ]
)


def _told(name: str, kind: DataType, comment: str) -> StructField:
    return StructField(name, kind, True, {"comment": comment})


# The twenty-four final columns, in table order, with their catalog comments.
FINAL_SCHEMA = StructType(
    [
        _told("trip_id", StringType(), "trip key"),
        _told("pickup_datetime", TimestampType(), "start of the trip"),
        _told("dropoff_datetime", TimestampType(), "end of the trip"),
        _told("pickup_borough", StringType(), "borough where the trip starts"),
        _told("dropoff_borough", StringType(), "borough where the trip ends"),
        _told("passenger_count", IntegerType(), "passengers on board"),
        _told("trip_distance_miles", DoubleType(), "miles driven"),
        _told("trip_duration_minutes", DoubleType(), "minutes between pickup and dropoff"),
        _told("avg_speed_mph", DoubleType(), "miles per hour over the whole trip"),
        _told("fare_amount", DoubleType(), "fare without tip and surcharges"),
        _told("tip_amount", DoubleType(), "tip"),
        _told("tip_percentage", DoubleType(), "tip as percent of the fare"),
        _told("total_amount", DoubleType(), "everything the rider paid"),
        _told("fare_per_mile", DoubleType(), "fare divided by miles"),
        _told("payment_type", StringType(), "how the trip was paid"),
        _told("pickup_hour", IntegerType(), "hour of the pickup, 0 to 23"),
        _told("time_of_day", StringType(), "Morning, Afternoon, Evening or Night"),
        _told("day_of_week", StringType(), "English name of the pickup day"),
        _told("is_weekend", BooleanType(), "pickup on Saturday or Sunday"),
        _told("borough_avg_fare", DoubleType(), "mean fare of the pickup borough"),
        _told("borough_avg_distance", DoubleType(), "mean miles of the pickup borough"),
        _told("fare_vs_borough_avg", DoubleType(), "fare minus the mean fare of the borough"),
        _told("trip_year", IntegerType(), "partition: year"),
        _told("trip_month", IntegerType(), "partition: month"),
    ]
)
