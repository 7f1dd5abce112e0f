"""KPI reports: grouped aggregates over the final trips, and the two anomaly lists.

Each report names its keys, measures and order. All measures have partial aggregation, so only one
row per group and task is shuffled. Sums and means do not depend on the order of rows. Orders end
with the group keys, which makes top-k results deterministic where counts tie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.sums import exact_mean, exact_sum
from tripmill.functions.trip_columns import day_type, month_label


def _mean(column: str, digits: int):
    return lambda: F.round(exact_mean(column), digits)


MEASURES = {
    "rows": lambda: F.count(F.lit(1)),
    "ids": lambda: F.count("trip_id"),
    "revenue": lambda: F.round(exact_sum("total_amount"), 2),
    "fare": _mean("fare_amount", 2),
    "tip percent": _mean("tip_percentage", 1),
    "distance": _mean("trip_distance_miles", 2),
    "duration": _mean("trip_duration_minutes", 1),
    "tip": _mean("tip_amount", 2),
    "fare per mile": _mean("fare_per_mile", 2),
}

DERIVED = {
    "day_type": lambda: day_type("is_weekend"),
    "month_label": lambda: month_label("trip_year", "trip_month"),
}


@dataclass(frozen=True)
class Report:
    """Grouping keys, output columns, sort columns and row limit.

    ``output`` lists keys, derived columns and (name, measure) pairs in result order. A sort column
    with a leading minus sorts downwards.
    """

    keys: tuple[str, ...]
    output: tuple[str | tuple[str, str], ...]
    order: tuple[str, ...] = ()
    limit: int | None = None


# Result column names, rounding, orders and limits.
REPORTS = {
    "kpi_borough": Report(
        keys=("pickup_borough",),
        output=(
            "pickup_borough",
            ("total_trips", "rows"),
            ("total_revenue_usd", "revenue"),
            ("avg_fare_usd", "fare"),
            ("avg_tip_pct", "tip percent"),
            ("avg_distance_miles", "distance"),
        ),
        order=("-total_revenue_usd",),
    ),
    "kpi_borough_basic": Report(
        keys=("pickup_borough",),
        output=(
            "pickup_borough",
            ("total_trips", "rows"),
            ("total_revenue", "revenue"),
            ("avg_fare", "fare"),
            ("avg_tip_pct", "tip percent"),
        ),
        order=("-total_revenue",),
    ),
    "kpi_borough_catalog": Report(
        keys=("pickup_borough",),
        output=(
            "pickup_borough",
            ("total_trips", "rows"),
            ("total_revenue", "revenue"),
            ("avg_fare", "fare"),
        ),
        order=("-total_revenue",),
    ),
    "borough_summary": Report(
        keys=("pickup_borough",),
        output=(
            "pickup_borough",
            ("total_trips", "ids"),
            ("avg_fare", "fare"),
            ("avg_distance", "distance"),
            ("avg_tip_pct", "tip percent"),
        ),
        order=("-total_trips",),
    ),
    "kpi_peak_hour": Report(
        keys=("pickup_hour", "time_of_day"),
        output=(
            "pickup_hour",
            "time_of_day",
            ("trip_count", "rows"),
            ("avg_fare", "fare"),
            ("avg_duration_min", "duration"),
            ("total_revenue", "revenue"),
        ),
        order=("pickup_hour",),
    ),
    "kpi_peak_hour_basic": Report(
        keys=("pickup_hour", "time_of_day"),
        output=(
            "pickup_hour",
            "time_of_day",
            ("trip_count", "rows"),
            ("avg_fare", "fare"),
            ("avg_duration_min", "duration"),
        ),
        order=("pickup_hour",),
    ),
    "kpi_time_of_day": Report(
        keys=("time_of_day",),
        output=(
            "time_of_day",
            ("trips", "rows"),
            ("avg_fare", "fare"),
            ("avg_duration_min", "duration"),
        ),
        order=("-trips",),
    ),
    "kpi_weekend": Report(
        keys=("is_weekend",),
        output=(
            "is_weekend",
            "day_type",
            ("total_trips", "rows"),
            ("avg_fare", "fare"),
            ("avg_distance", "distance"),
            ("avg_tip_pct", "tip percent"),
            ("total_revenue", "revenue"),
        ),
        order=("is_weekend",),
    ),
    "kpi_weekend_basic": Report(
        keys=("is_weekend",),
        output=(
            "is_weekend",
            ("total_trips", "rows"),
            ("avg_fare", "fare"),
            ("avg_distance", "distance"),
            ("avg_tip_pct", "tip percent"),
        ),
    ),
    "kpi_day_type": Report(
        keys=("is_weekend",),
        output=(
            "day_type",
            ("trips", "rows"),
            ("avg_fare", "fare"),
            ("avg_tip_pct", "tip percent"),
        ),
    ),
    "kpi_od_pairs": Report(
        keys=("pickup_borough", "dropoff_borough"),
        output=(
            "pickup_borough",
            "dropoff_borough",
            ("trip_count", "rows"),
            ("avg_fare", "fare"),
            ("avg_tip_pct", "tip percent"),
        ),
        order=("-trip_count",),
        limit=15,
    ),
    "kpi_od_pairs_top10": Report(
        keys=("pickup_borough", "dropoff_borough"),
        output=(
            "pickup_borough",
            "dropoff_borough",
            ("trip_count", "rows"),
            ("avg_fare", "fare"),
        ),
        order=("-trip_count",),
        limit=10,
    ),
    "kpi_payment": Report(
        keys=("payment_type",),
        output=(
            "payment_type",
            ("trip_count", "rows"),
            ("total_revenue", "revenue"),
            ("avg_tip", "tip"),
            ("avg_tip_pct", "tip percent"),
        ),
        order=("-trip_count",),
    ),
    "kpi_payment_basic": Report(
        keys=("payment_type",),
        output=(
            "payment_type",
            ("trips", "rows"),
            ("avg_tip", "tip"),
            ("total_revenue", "revenue"),
        ),
        order=("-trips",),
    ),
    "verify_monthly": Report(
        keys=("trip_year", "trip_month"),
        output=(
            "trip_year",
            "trip_month",
            ("total_trips", "rows"),
            ("avg_fare", "fare"),
            ("avg_distance", "distance"),
        ),
        order=("trip_year", "trip_month"),
    ),
    "kpi_monthly_catalog": Report(
        keys=("trip_year", "trip_month"),
        output=(
            "trip_year",
            "trip_month",
            ("trips", "rows"),
            ("avg_fare", "fare"),
        ),
        order=("trip_year", "trip_month"),
    ),
    "kpi_monthly": Report(
        keys=("trip_year", "trip_month"),
        output=(
            "trip_year",
            "trip_month",
            "month_label",
            ("total_trips", "rows"),
            ("monthly_revenue", "revenue"),
            ("avg_fare", "fare"),
        ),
        order=("trip_year", "trip_month"),
    ),
    "kpi_fare_per_mile": Report(
        keys=("pickup_borough",),
        output=(
            "pickup_borough",
            ("avg_fare_per_mile", "fare per mile"),
        ),
        order=("-avg_fare_per_mile",),
    ),
    "kpi_shift_revenue": Report(
        keys=("time_of_day",),
        output=(
            "time_of_day",
            ("trips", "rows"),
            ("total_revenue", "revenue"),
            ("avg_fare", "fare"),
        ),
        order=("-total_revenue",),
    ),
}

# The reports answered when no warehouse is configured.
SERVED_REPORTS = (
    "kpi_borough_basic",
    "kpi_peak_hour_basic",
    "kpi_weekend_basic",
    "kpi_od_pairs_top10",
    "kpi_payment_basic",
)


def _sort_column(name: str) -> Column:
    return F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc()


def kpi(trips: DataFrame, name: str) -> DataFrame:
    """The named report over the final trips."""
    report = REPORTS[name]
    measures, columns = [], []
    for item in report.output:
        column, measure = item if isinstance(item, tuple) else (item, None)
        if measure:
            measures.append(MEASURES[measure]().alias(column))
        columns.append(DERIVED[column]().alias(column) if column in DERIVED else F.col(column))
    grouped = trips.groupBy(*report.keys).agg(*measures)
    if report.order:
        ties = [key for key in report.keys if key not in report.order]
        grouped = grouped.orderBy(*map(_sort_column, [*report.order, *ties]))
    if report.limit is not None:
        grouped = grouped.limit(report.limit)
    return grouped.select(*columns)


def count_total(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("total"))


def count_partition(
    trips: DataFrame, year: int, month: int, name: str = "month_trips"
) -> DataFrame:
    """Trips of one month; over a partitioned table only that month's folder is read."""
    one_month = (F.col("trip_year") == year) & (F.col("trip_month") == month)
    return trips.where(one_month).agg(F.count(F.lit(1)).alias(name))


def anomaly_fare(trips: DataFrame, limit: int = 20) -> DataFrame:
    """Fares more than half above their borough's mean, largest difference first."""
    return (
        trips.where(F.col("fare_vs_borough_avg") > F.col("borough_avg_fare") * 0.5)
        .select(
            "trip_id",
            "pickup_borough",
            "fare_amount",
            "borough_avg_fare",
            "fare_vs_borough_avg",
            "trip_distance_miles",
            "trip_duration_minutes",
        )
        .orderBy(F.desc("fare_vs_borough_avg"), "trip_id")
        .limit(limit)
    )


def anomaly_speed(trips: DataFrame) -> DataFrame:
    """Trips faster than 60 or slower than 1 mile per hour, fastest first.

    The trip id ends the sort, so the range partitions split even many equal speeds.
    """
    speed = F.col("avg_speed_mph")
    return (
        trips.where((speed > 60) | (speed < 1))
        .select(
            "trip_id",
            "avg_speed_mph",
            "trip_distance_miles",
            "trip_duration_minutes",
            "pickup_borough",
            "time_of_day",
        )
        .orderBy(F.desc("avg_speed_mph"), "trip_id")
    )
