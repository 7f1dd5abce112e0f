"""Trip view over the test tables: one raw trip per line item.

Five regions stand for five boroughs. The view holds duplicates, nulls, bad ranges, malformed
times, zero durations and long trips on purpose. It needs the session time zone UTC.
Every join is on a key; the planner broadcasts a side only when its files are small enough,
otherwise adaptive execution splits a hot key. The orders come last, so the rows stay placed by order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.trip_columns import DATETIME_PATTERN
from tripmill.schemas import RAW_SCHEMA

#: What a trip id is made of; an id determines both.
ID_PARTS = ("l_orderkey", "l_linenumber")
SOURCE_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def _later(moment: Column, unit: str, amount: Column) -> Column:
    return moment + F.make_dt_interval(**{unit: amount})


def trip_view(spark: SparkSession, sf_dir: str, parts: bool = False) -> DataFrame:
    """The raw trips; with ``parts``, each behind the ``ID_PARTS`` that its id is made of."""
    table = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in SOURCE_TABLES}
    places = table["nation"].join(
        table["region"], F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    pickups = (
        table["orders"]
        .join(table["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderpriority", F.col("r_name").alias("pickup_borough"))
    )
    ends = places.select(F.col("n_nationkey").alias("end_nationkey"), F.col("r_name").alias("dropoff_borough"))
    joined = (
        table["lineitem"]
        .join(table["supplier"].select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(ends, F.col("s_nationkey") == F.col("end_nationkey"))
        .join(pickups, F.col("l_orderkey") == F.col("o_orderkey"))
    )

    part, order, line = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_linenumber")

    def every(n: int) -> Column:
        return part % n == 0

    minutes = F.lit(3) + (part * 31 + order * 17) % 88
    helped = joined.withColumns(
        {
            "sod": ((order * 7919 + part * 104729 + line * 1299709) % 86400).cast("int"),
            "m2": F.when(every(127), 0)
            .when(every(53), minutes * 10)
            .otherwise(minutes)
            .cast("int"),
            "fc": F.floor(
                F.round(F.col("l_extendedprice") * 100).cast("long") / F.lit(1000.0)
            ).cast("long")
            + 100,
        }
    ).withColumns(
        {
            "pk": _later(F.col("l_shipdate").cast("timestamp"), "secs", F.col("sod")),
            "tc": F.floor(F.col("fc") * F.col("l_discount")).cast("long"),
        }
    )
    dropoff = _later(F.col("pk"), "mins", F.col("m2"))
    dollars = F.col("fc") / F.lit(100.0)
    columns = {
        "trip_id": F.when(~every(109), F.concat_ws("_", F.lit("TRIP"), order, line)),
        "pickup_datetime": F.when(every(113), F.lit(None))
        .when(every(131), "not a time")
        .otherwise(F.date_format("pk", DATETIME_PATTERN)),
        "dropoff_datetime": F.date_format(dropoff, DATETIME_PATTERN),
        "pickup_borough": F.col("pickup_borough"),
        "dropoff_borough": F.col("dropoff_borough"),
        "passenger_count": line,
        "trip_distance_miles": F.when(every(107), 0.0).otherwise(
            F.col("l_quantity") * F.lit(0.5)
        ),
        "fare_amount": F.when(every(101), F.lit(None)).when(every(103), -dollars).otherwise(dollars),
        "tip_amount": F.col("tc") / F.lit(100.0),
        "total_amount": (F.col("fc") + F.col("tc") + 50) / F.lit(100.0),
        "payment_type": F.col("o_orderpriority"),
        "trip_year": F.year("pk"),
        "trip_month": F.month("pk"),
    }
    return helped.select(
        *(ID_PARTS if parts else ()),
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in RAW_SCHEMA]
    )
