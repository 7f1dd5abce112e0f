"""Feature operators: timestamps, derived columns, final projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import trip_columns as tc
from tripmill.schemas import FINAL_SCHEMA


def cast_timestamps(trips: DataFrame) -> DataFrame:
    """Parse both datetime columns in place; text that is no datetime becomes null."""
    return trips.withColumns(
        {name: tc.parsed_datetime(name) for name in ("pickup_datetime", "dropoff_datetime")}
    )


def engineer_features(trips: DataFrame) -> DataFrame:
    """Parse the datetimes and append the eight derived columns."""
    timed = cast_timestamps(trips).withColumn(
        "trip_duration_minutes", tc.duration_minutes("pickup_datetime", "dropoff_datetime")
    )
    measured = timed.withColumns(
        {
            "avg_speed_mph": tc.speed_mph("trip_distance_miles", "trip_duration_minutes"),
            "fare_per_mile": tc.per_mile("fare_amount", "trip_distance_miles"),
            "tip_percentage": tc.percent_of("tip_amount", "fare_amount"),
            "pickup_hour": F.hour("pickup_datetime"),
        }
    )
    return measured.withColumns(
        {
            "time_of_day": tc.day_part("pickup_hour"),
            "is_weekend": tc.falls_on_weekend("pickup_datetime"),
            "day_of_week": tc.day_name("pickup_datetime"),
        }
    )


def final_columns(trips: DataFrame) -> DataFrame:
    """The twenty-four table columns, in table order."""
    return trips.select(*FINAL_SCHEMA.names)
