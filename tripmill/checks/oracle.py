"""DuckDB SQL for every query, over the same Parquet tables.

Common table expressions build up the chain raw, clean, featured, fenced, final; a query takes the
prefix it needs. Spark rounds the decimal text of a double half up; ``rnd`` does the same here.
"""

from __future__ import annotations

from tripmill.checks.queries import MONTH, PREVIEW_COLUMNS

# Written out, so that a wrong order in the code under test cannot pass on both sides.
RAW_NAMES = (
    "trip_id pickup_datetime dropoff_datetime pickup_borough dropoff_borough passenger_count "
    "trip_distance_miles fare_amount tip_amount total_amount payment_type trip_year trip_month"
).split()
FINAL_TYPES = {
    "trip_id": "string", "pickup_datetime": "timestamp", "dropoff_datetime": "timestamp",
    "pickup_borough": "string", "dropoff_borough": "string", "passenger_count": "int",
    "trip_distance_miles": "double", "trip_duration_minutes": "double", "avg_speed_mph": "double",
    "fare_amount": "double", "tip_amount": "double", "tip_percentage": "double",
    "total_amount": "double", "fare_per_mile": "double", "payment_type": "string",
    "pickup_hour": "int", "time_of_day": "string", "day_of_week": "string", "is_weekend": "boolean",
    "borough_avg_fare": "double", "borough_avg_distance": "double", "fare_vs_borough_avg": "double",
    "trip_year": "int", "trip_month": "int",
}
FENCE_ORDER = ("trip_distance_miles", "fare_amount", "trip_duration_minutes", "avg_speed_mph")


def rnd(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def total(column: str, over: str = "") -> str:
    """A sum in decimals, which no order of rows changes."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,6))) {over} AS DOUBLE)"


def mean(column: str, over: str = "") -> str:
    return f"({total(column, over)} / NULLIF(COUNT({column}) {over}, 0))"


RAW = """
helped AS (
  SELECT l.*, o.o_orderpriority, pr.r_name AS pickup_borough, dr.r_name AS dropoff_borough,
    (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) % 86400 AS sod,
    CASE WHEN l_partkey % 127 = 0 THEN 0
         WHEN l_partkey % 53 = 0 THEN (3 + (l_partkey * 31 + l_orderkey * 17) % 88) * 10
         ELSE 3 + (l_partkey * 31 + l_orderkey * 17) % 88 END AS m2,
    CAST(FLOOR(CAST(ROUND(l_extendedprice * 100) AS BIGINT) / CAST(1000 AS DOUBLE)) AS BIGINT)
      + 100 AS fc
  FROM lineitem l
  JOIN orders o ON l_orderkey = o_orderkey
  JOIN customer c ON o_custkey = c_custkey
  JOIN nation pn ON c_nationkey = pn.n_nationkey
  JOIN region pr ON pn.n_regionkey = pr.r_regionkey
  JOIN supplier s ON l_suppkey = s_suppkey
  JOIN nation dn ON s_nationkey = dn.n_nationkey
  JOIN region dr ON dn.n_regionkey = dr.r_regionkey
),
timed AS (
  SELECT *, l_shipdate + to_seconds(sod) AS pk, CAST(FLOOR(fc * l_discount) AS BIGINT) AS tc
  FROM helped
),
raw AS MATERIALIZED (
  SELECT
    CASE WHEN l_partkey % 109 = 0 THEN NULL
         ELSE 'TRIP_' || l_orderkey || '_' || l_linenumber END AS trip_id,
    CASE WHEN l_partkey % 113 = 0 THEN NULL
         WHEN l_partkey % 131 = 0 THEN 'not a time'
         ELSE strftime(pk, '%Y-%m-%d %H:%M:%S') END AS pickup_datetime,
    strftime(pk + to_minutes(m2), '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
    pickup_borough,
    dropoff_borough,
    CAST(l_linenumber AS INTEGER) AS passenger_count,
    CASE WHEN l_partkey % 107 = 0 THEN CAST(0 AS DOUBLE)
         ELSE l_quantity * CAST(0.5 AS DOUBLE) END AS trip_distance_miles,
    CASE WHEN l_partkey % 101 = 0 THEN NULL
         WHEN l_partkey % 103 = 0 THEN -(fc / CAST(100 AS DOUBLE))
         ELSE fc / CAST(100 AS DOUBLE) END AS fare_amount,
    tc / CAST(100 AS DOUBLE) AS tip_amount,
    (fc + tc + 50) / CAST(100 AS DOUBLE) AS total_amount,
    o_orderpriority AS payment_type,
    CAST(year(pk) AS INTEGER) AS trip_year,
    CAST(month(pk) AS INTEGER) AS trip_month
  FROM timed
)"""

_ORDER = ", ".join(f"{name} ASC NULLS LAST" for name in RAW_NAMES[1:])

CLEAN = f"""{RAW},
survivors AS MATERIALIZED (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY {_ORDER}) AS place FROM raw
  ) WHERE place = 1
),
clean AS MATERIALIZED (
  SELECT * FROM survivors
  WHERE fare_amount > 0 AND trip_distance_miles > 0 AND trip_id IS NOT NULL
)"""

FEATURED = f"""{CLEAN},
parsed AS (
  SELECT * REPLACE (
    try_strptime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
    try_strptime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime)
  FROM clean
),
lasting AS (
  SELECT *,
    {rnd("date_diff('second', pickup_datetime, dropoff_datetime) / CAST(60 AS DOUBLE)", 2)}
      AS trip_duration_minutes
  FROM parsed
),
measured AS (
  SELECT *,
    {rnd("trip_distance_miles / NULLIF(trip_duration_minutes / CAST(60 AS DOUBLE), 0)", 2)}
      AS avg_speed_mph,
    {rnd("fare_amount / NULLIF(trip_distance_miles, 0)", 2)} AS fare_per_mile,
    {rnd("tip_amount / NULLIF(fare_amount, 0) * CAST(100 AS DOUBLE)", 1)} AS tip_percentage,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour
  FROM lasting
),
featured AS MATERIALIZED (
  SELECT *,
    CASE WHEN pickup_hour BETWEEN 6 AND 11 THEN 'Morning'
         WHEN pickup_hour BETWEEN 12 AND 16 THEN 'Afternoon'
         WHEN pickup_hour BETWEEN 17 AND 21 THEN 'Evening'
         ELSE 'Night' END AS time_of_day,
    COALESCE(dayofweek(pickup_datetime) IN (0, 6), FALSE) AS is_weekend,
    dayname(pickup_datetime) AS day_of_week
  FROM measured
)"""


def fence(step: int, source: str, column: str) -> str:
    """Bounds of the column over ``source``, and the rows inside them."""
    width = "CAST(1.5 AS DOUBLE) * (q3 - q1)"
    return f"""
q{step} AS MATERIALIZED (
  SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {source}
),
b{step} AS MATERIALIZED (SELECT q1 - {width} AS lo, q3 + {width} AS hi FROM q{step}),
f{step} AS MATERIALIZED (
  SELECT * FROM {source}
  WHERE (SELECT lo IS NULL FROM b{step})
     OR {column} BETWEEN (SELECT lo FROM b{step}) AND (SELECT hi FROM b{step})
)"""


FENCED = ",".join(
    [FEATURED]
    + [
        fence(i, f"f{i - 1}" if i > 1 else "featured", column)
        for i, column in enumerate(FENCE_ORDER, 1)
    ]
)


def compared(source: str, name: str) -> str:
    """``source`` with the borough averages and the fare's difference, by window."""
    fare = rnd(mean("fare_amount", "OVER (PARTITION BY pickup_borough)"), 2)
    miles = rnd(mean("trip_distance_miles", "OVER (PARTITION BY pickup_borough)"), 2)
    return f"""
{name} AS MATERIALIZED (
  SELECT *, {rnd("fare_amount - borough_avg_fare", 2)} AS fare_vs_borough_avg
  FROM (SELECT *, {fare} AS borough_avg_fare, {miles} AS borough_avg_distance FROM {source})
)"""


FINAL_NAMES = ", ".join(FINAL_TYPES)
FINAL = f"""{FENCED},{compared("f4", "kept")},
final AS MATERIALIZED (SELECT {FINAL_NAMES} FROM kept)"""
UNFENCED = f"""{FEATURED},{compared("featured", "unfenced")}"""


def on(chain: str, select: str) -> str:
    return f"WITH {chain}\n{select}"


REVENUE = rnd(total("total_amount"), 2)
FARE = rnd(mean("fare_amount"), 2)
TIP_PCT = rnd(mean("tip_percentage"), 1)
MILES = rnd(mean("trip_distance_miles"), 2)
MINUTES = rnd(mean("trip_duration_minutes"), 1)
TIP = rnd(mean("tip_amount"), 2)
PER_MILE = rnd(mean("fare_per_mile"), 2)
DAY_TYPE = "CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END"

BOROUGH_BASIC = f"""
SELECT pickup_borough, COUNT(*) AS total_trips, {REVENUE} AS total_revenue, {FARE} AS avg_fare,
  {TIP_PCT} AS avg_tip_pct
FROM final GROUP BY pickup_borough"""
PEAK_HOUR_BASIC = f"""
SELECT pickup_hour, time_of_day, COUNT(*) AS trip_count, {FARE} AS avg_fare,
  {MINUTES} AS avg_duration_min
FROM final GROUP BY pickup_hour, time_of_day"""
WEEKEND_BASIC = f"""
SELECT is_weekend, COUNT(*) AS total_trips, {FARE} AS avg_fare, {MILES} AS avg_distance,
  {TIP_PCT} AS avg_tip_pct
FROM final GROUP BY is_weekend"""
OD_TOP10 = f"""
SELECT pickup_borough, dropoff_borough, COUNT(*) AS trip_count, {FARE} AS avg_fare
FROM final GROUP BY pickup_borough, dropoff_borough
ORDER BY trip_count DESC, pickup_borough, dropoff_borough LIMIT 10"""
PAYMENT_BASIC = f"""
SELECT payment_type, COUNT(*) AS trips, {TIP} AS avg_tip, {REVENUE} AS total_revenue
FROM final GROUP BY payment_type"""
MONTHLY = f"""
SELECT trip_year, trip_month, COUNT(*) AS total_trips, {FARE} AS avg_fare, {MILES} AS avg_distance
FROM final GROUP BY trip_year, trip_month"""


def tall(report: str, sql: str, key: str, measures: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{report}' AS report, {key} AS group_key, '{measure}' AS measure, "
        f"CAST({measure} AS DOUBLE) AS measured FROM ({sql})"
        for measure in measures.split()
    )


SERVED = "\nUNION ALL\n".join(
    [
        tall(
            "kpi_borough_basic",
            BOROUGH_BASIC,
            "pickup_borough",
            "total_trips total_revenue avg_fare avg_tip_pct",
        ),
        tall(
            "kpi_peak_hour_basic",
            PEAK_HOUR_BASIC,
            "concat_ws('|', CAST(pickup_hour AS VARCHAR), time_of_day)",
            "trip_count avg_fare avg_duration_min",
        ),
        tall(
            "kpi_weekend_basic",
            WEEKEND_BASIC,
            "CAST(is_weekend AS VARCHAR)",
            "total_trips avg_fare avg_distance avg_tip_pct",
        ),
        tall(
            "kpi_od_pairs_top10",
            OD_TOP10,
            "concat_ws('|', pickup_borough, dropoff_borough)",
            "trip_count avg_fare",
        ),
        tall("kpi_payment_basic", PAYMENT_BASIC, "payment_type", "trips avg_tip total_revenue"),
    ]
)

QUALITY = """
SELECT total_records, null_trip_id, null_pickup_datetime, null_fare_amount,
  null_trip_distance_miles, invalid_fare, invalid_distance,
  total_records - (SELECT COUNT(*) FROM survivors) AS duplicate_ids,
  (SELECT COUNT(*) FROM clean) AS clean_records,
  total_records - (SELECT COUNT(*) FROM clean) AS rejected_records
FROM (
  SELECT COUNT(*) AS total_records,
    COUNT(*) FILTER (trip_id IS NULL) AS null_trip_id,
    COUNT(*) FILTER (pickup_datetime IS NULL) AS null_pickup_datetime,
    COUNT(*) FILTER (fare_amount IS NULL) AS null_fare_amount,
    COUNT(*) FILTER (trip_distance_miles IS NULL) AS null_trip_distance_miles,
    COUNT(*) FILTER (fare_amount <= 0) AS invalid_fare,
    COUNT(*) FILTER (trip_distance_miles <= 0) AS invalid_distance
  FROM raw)"""

QUARTILES = "\nUNION ALL\n".join(
    f"SELECT '{column}' AS column_name, quantile_disc({column}, 0.25) AS q1, "
    f"quantile_disc({column}, 0.75) AS q3 FROM featured"
    for column in FENCE_ORDER
)


def _fence_row(step: int, column: str) -> str:
    before = f"(SELECT COUNT(*) FROM {f'f{step - 1}' if step > 1 else 'featured'})"
    after = f"(SELECT COUNT(*) FROM f{step})"
    return (
        f"SELECT CAST({step} AS INTEGER) AS fence_order, '{column}' AS column_name, "
        f"lo AS lower_bound, hi AS upper_bound, {before} AS rows_before, {after} AS rows_after, "
        f"{before} - {after} AS rows_removed FROM b{step}"
    )


FENCE_REPORT = "\nUNION ALL\n".join(
    _fence_row(i, column) for i, column in enumerate(FENCE_ORDER, 1)
)

# What the catalog must show for the final table: its columns, and how many rows fill them.
_COMMENTS = {
    "trip_id": "trip key",
    "pickup_datetime": "start of the trip",
    "dropoff_datetime": "end of the trip",
    "pickup_borough": "borough where the trip starts",
    "dropoff_borough": "borough where the trip ends",
    "passenger_count": "passengers on board",
    "trip_distance_miles": "miles driven",
    "trip_duration_minutes": "minutes between pickup and dropoff",
    "avg_speed_mph": "miles per hour over the whole trip",
    "fare_amount": "fare without tip and surcharges",
    "tip_amount": "tip",
    "tip_percentage": "tip as percent of the fare",
    "total_amount": "everything the rider paid",
    "fare_per_mile": "fare divided by miles",
    "payment_type": "how the trip was paid",
    "pickup_hour": "hour of the pickup, 0 to 23",
    "time_of_day": "Morning, Afternoon, Evening or Night",
    "day_of_week": "English name of the pickup day",
    "is_weekend": "pickup on Saturday or Sunday",
    "borough_avg_fare": "mean fare of the pickup borough",
    "borough_avg_distance": "mean miles of the pickup borough",
    "fare_vs_borough_avg": "fare minus the mean fare of the borough",
    "trip_year": "partition: year",
    "trip_month": "partition: month",
}
DESCRIBED = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS col_name, '{kind}' AS data_type, '{_COMMENTS[name]}' AS comment, "
    f"COUNT({name}) AS filled_rows FROM final"
    for name, kind in FINAL_TYPES.items()
)

RAW_ROWS = on(RAW, "SELECT * FROM raw")
CLEAN_ROWS = on(CLEAN, "SELECT * FROM clean")
FINAL_ROWS = on(FINAL, "SELECT * FROM final")


def _feature(column: str) -> str:
    return on(FEATURED, f"SELECT trip_id, {column} FROM featured")


ORACLES = {
    "scan_csv_schema": RAW_ROWS,
    "sink_parquet_partitioned": CLEAN_ROWS,
    "scan_parquet_partitioned": CLEAN_ROWS,
    "catalog_register": FINAL_ROWS,
    "catalog_repair_partitions": on(
        FINAL,
        "SELECT CAST(0 AS BIGINT) AS rows_before_repair, COUNT(*) AS rows_after_repair FROM final",
    ),
    "catalog_managed_table": FINAL_ROWS,
    "catalog_show_partitions": on(
        FINAL,
        "SELECT DISTINCT 'trip_year=' || trip_year || '/trip_month=' || trip_month AS partition "
        "FROM final",
    ),
    "catalog_describe": on(FINAL, DESCRIBED),
    "verify_monthly": on(FINAL, MONTHLY),
    "sink_warehouse": FINAL_ROWS,
    "observe_counts": on(
        FINAL,
        """
SELECT 'ingested' AS step, COUNT(*) AS step_rows FROM raw
UNION ALL SELECT 'staged', COUNT(*) FROM clean
UNION ALL SELECT 'loaded', COUNT(*) FROM featured
UNION ALL SELECT 'written', COUNT(*) FROM final""",
    ),
    "preview": on(
        FINAL, f"SELECT {', '.join(PREVIEW_COLUMNS)} FROM final ORDER BY trip_id LIMIT 10"
    ),
    "quality_report": on(CLEAN, QUALITY),
    "dedupe_trips": on(CLEAN, "SELECT * FROM survivors"),
    "clean_trips": CLEAN_ROWS,
    "cast_timestamps": on(FEATURED, "SELECT * FROM parsed"),
    "feat_duration": _feature("trip_duration_minutes"),
    "feat_speed": _feature("avg_speed_mph"),
    "feat_fare_per_mile": _feature("fare_per_mile"),
    "feat_tip_pct": _feature("tip_percentage"),
    "feat_hour": _feature("pickup_hour"),
    "feat_time_of_day": _feature("time_of_day"),
    "feat_is_weekend": _feature("is_weekend"),
    "feat_day_name": _feature("day_of_week"),
    "engineer_features": on(FEATURED, "SELECT * FROM featured"),
    "final_columns": on(UNFENCED, f"SELECT {FINAL_NAMES} FROM unfenced"),
    "quartiles": on(FEATURED, QUARTILES),
    "quartiles_approx": on(
        FEATURED,
        "\nUNION ALL\n".join(
            f"SELECT '{column}' AS column_name, COUNT({column}) AS usable_rows, "
            "TRUE AS q1_holds, TRUE AS q3_holds FROM featured"
            for column in FENCE_ORDER
        ),
    ),
    "iqr_single": on(
        f"{FEATURED},{fence(1, 'featured', 'avg_speed_mph')}", "SELECT * FROM f1"
    ),
    "remove_outliers": on(FENCED, "SELECT * FROM f4"),
    "outlier_report": on(FENCED, FENCE_REPORT),
    "borough_metrics": on(UNFENCED, "SELECT * FROM unfenced"),
    "borough_trip_rank": on(
        FINAL,
        "SELECT trip_id, pickup_borough, fare_amount, CAST(rank() OVER (PARTITION BY "
        "pickup_borough ORDER BY fare_amount DESC) AS BIGINT) AS borough_trip_rank FROM final",
    ),
    "kpi_borough": on(
        FINAL,
        f"""
SELECT pickup_borough, COUNT(*) AS total_trips, {REVENUE} AS total_revenue_usd,
  {FARE} AS avg_fare_usd, {TIP_PCT} AS avg_tip_pct, {MILES} AS avg_distance_miles
FROM final GROUP BY pickup_borough""",
    ),
    "kpi_borough_basic": on(FINAL, BOROUGH_BASIC),
    "kpi_borough_catalog": on(
        FINAL,
        f"""
SELECT pickup_borough, COUNT(*) AS total_trips, {REVENUE} AS total_revenue, {FARE} AS avg_fare
FROM final GROUP BY pickup_borough""",
    ),
    "borough_summary": on(
        FINAL,
        f"""
SELECT pickup_borough, COUNT(trip_id) AS total_trips, {FARE} AS avg_fare, {MILES} AS avg_distance,
  {TIP_PCT} AS avg_tip_pct
FROM final GROUP BY pickup_borough""",
    ),
    "kpi_peak_hour": on(
        FINAL,
        f"""
SELECT pickup_hour, time_of_day, COUNT(*) AS trip_count, {FARE} AS avg_fare,
  {MINUTES} AS avg_duration_min, {REVENUE} AS total_revenue
FROM final GROUP BY pickup_hour, time_of_day""",
    ),
    "kpi_peak_hour_basic": on(FINAL, PEAK_HOUR_BASIC),
    "kpi_time_of_day": on(
        FINAL,
        f"""
SELECT time_of_day, COUNT(*) AS trips, {FARE} AS avg_fare, {MINUTES} AS avg_duration_min
FROM final GROUP BY time_of_day""",
    ),
    "kpi_weekend": on(
        FINAL,
        f"""
SELECT is_weekend, {DAY_TYPE} AS day_type, COUNT(*) AS total_trips, {FARE} AS avg_fare,
  {MILES} AS avg_distance, {TIP_PCT} AS avg_tip_pct, {REVENUE} AS total_revenue
FROM final GROUP BY is_weekend""",
    ),
    "kpi_weekend_basic": on(FINAL, WEEKEND_BASIC),
    "kpi_day_type": on(
        FINAL,
        f"""
SELECT {DAY_TYPE} AS day_type, COUNT(*) AS trips, {FARE} AS avg_fare, {TIP_PCT} AS avg_tip_pct
FROM final GROUP BY is_weekend""",
    ),
    "kpi_od_pairs": on(
        FINAL,
        f"""
SELECT pickup_borough, dropoff_borough, COUNT(*) AS trip_count, {FARE} AS avg_fare,
  {TIP_PCT} AS avg_tip_pct
FROM final GROUP BY pickup_borough, dropoff_borough
ORDER BY trip_count DESC, pickup_borough, dropoff_borough LIMIT 15""",
    ),
    "kpi_od_pairs_top10": on(FINAL, OD_TOP10),
    "kpi_payment": on(
        FINAL,
        f"""
SELECT payment_type, COUNT(*) AS trip_count, {REVENUE} AS total_revenue, {TIP} AS avg_tip,
  {TIP_PCT} AS avg_tip_pct
FROM final GROUP BY payment_type""",
    ),
    "kpi_payment_basic": on(FINAL, PAYMENT_BASIC),
    "kpi_monthly_catalog": on(
        FINAL,
        f"""
SELECT trip_year, trip_month, COUNT(*) AS trips, {FARE} AS avg_fare
FROM final GROUP BY trip_year, trip_month""",
    ),
    "kpi_monthly": on(
        FINAL,
        f"""
SELECT trip_year, trip_month,
  strftime(make_date(trip_year, trip_month, 1), '%b %Y') AS month_label,
  COUNT(*) AS total_trips, {REVENUE} AS monthly_revenue, {FARE} AS avg_fare
FROM final GROUP BY trip_year, trip_month""",
    ),
    "kpi_fare_per_mile": on(
        FINAL,
        f"""
SELECT pickup_borough, {PER_MILE} AS avg_fare_per_mile
FROM final GROUP BY pickup_borough""",
    ),
    "kpi_shift_revenue": on(
        FINAL,
        f"""
SELECT time_of_day, COUNT(*) AS trips, {REVENUE} AS total_revenue, {FARE} AS avg_fare
FROM final GROUP BY time_of_day""",
    ),
    "count_partition": on(
        FINAL,
        f"SELECT COUNT(*) AS jan_trips FROM final "
        f"WHERE trip_year = {MONTH[0]} AND trip_month = {MONTH[1]}",
    ),
    "count_total": on(FINAL, "SELECT COUNT(*) AS total FROM final"),
    "anomaly_fare": on(
        FINAL,
        """
SELECT trip_id, pickup_borough, fare_amount, borough_avg_fare, fare_vs_borough_avg,
  trip_distance_miles, trip_duration_minutes
FROM final WHERE fare_vs_borough_avg > borough_avg_fare * CAST(0.5 AS DOUBLE)
ORDER BY fare_vs_borough_avg DESC, trip_id LIMIT 20""",
    ),
    "anomaly_speed": on(
        FINAL,
        """
SELECT trip_id, avg_speed_mph, trip_distance_miles, trip_duration_minutes, pickup_borough,
  time_of_day
FROM final WHERE avg_speed_mph > 60 OR avg_speed_mph < 1""",
    ),
    "serve_kpis": on(FINAL, SERVED),
    "job_ingest": CLEAN_ROWS,
    "job_transform": FINAL_ROWS,
    "job_transform_no_outliers": on(UNFENCED, "SELECT * FROM unfenced"),
    "job_register": FINAL_ROWS,
    "job_pipeline": on(FINAL, SERVED),
}
