"""Hand-written rows for the behaviour that must not drift."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tripmill.functions import trip_columns as tc
from tripmill.operators import features, kpis, metrics, outliers, quality
from tripmill.schemas import FINAL_SCHEMA, RAW_SCHEMA

NAN = float("nan")


def trip(**changes):
    base = {
        "trip_id": "a",
        "pickup_datetime": "2024-01-08 10:00:00",
        "dropoff_datetime": "2024-01-08 10:30:00",
        "pickup_borough": "Queens",
        "dropoff_borough": "Bronx",
        "passenger_count": 1,
        "trip_distance_miles": 2.0,
        "fare_amount": 10.0,
        "tip_amount": 1.0,
        "total_amount": 11.5,
        "payment_type": "Cash",
        "trip_year": 2024,
        "trip_month": 1,
    }
    return tuple({**base, **changes}.values())


@pytest.fixture
def raw(spark):
    return lambda *rows: spark.createDataFrame(list(rows), RAW_SCHEMA)


def test_zero_negative_and_unparsed_durations(raw):
    rows = features.engineer_features(
        raw(
            trip(trip_id="zero", dropoff_datetime="2024-01-08 10:00:00"),
            trip(trip_id="back", dropoff_datetime="2024-01-08 09:54:00"),
            trip(trip_id="text", pickup_datetime="not a time"),
            trip(trip_id="none", pickup_datetime=None),
        )
    ).collect()
    by_id = {row.trip_id: row for row in rows}
    assert (by_id["zero"].trip_duration_minutes, by_id["zero"].avg_speed_mph) == (0.0, None)
    assert (by_id["back"].trip_duration_minutes, by_id["back"].avg_speed_mph) == (-6.0, -20.0)
    for name in ("text", "none"):
        row = by_id[name]
        assert row.pickup_datetime is None and row.trip_duration_minutes is None
        assert row.avg_speed_mph is None and row.pickup_hour is None and row.day_of_week is None
        assert (row.time_of_day, row.is_weekend) == ("Night", False)


def test_parse_equals_the_pattern_parse(spark):
    texts = [
        None, "", " ", "not a time", "2024-02-29 23:59:59", "2023-02-29 10:00:00",
        "2024-13-01 10:00:00", "2024-00-10 10:00:00", "2024-01-32 00:00:00", "2024-01-08 24:00:00",
        "2024-01-08 10:60:00", "2024-01-08 10:00:60", "2024-01-08", "2024-01-08 10:00",
        "2024-01-08T10:00:00", "2024-01-08 10:00:00.5", "2024-01-08 10:00:00Z",
        "2024-01-08 10:00:00 ", " 2024-01-08 10:00:00", "2024-1-8 10:00:00", "0000-01-01 00:00:00",
        "0001-01-01 00:00:00", "9999-12-31 23:59:59", "1582-10-10 12:00:00", "1883-11-18 12:00:00",
        "-2024-01-08 10:00:00", "+12024-01-08 10:00:00", "2024-01-08 10:00:00\n",
        "2024-03-10 02:30:00", "2024-11-03 01:30:00", "１２２４-01-08 10:00:00",
    ]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            both = frame.select(
                "text",
                F.unix_micros(tc.parsed_datetime("text")).alias("ours"),
                F.unix_micros(
                    F.try_to_timestamp("text", F.lit(tc.DATETIME_PATTERN))
                ).alias("pattern"),
            ).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [(r.text, r.ours) for r in both] == [(r.text, r.pattern) for r in both]
        assert sum(r.ours is not None for r in both) >= 8


def test_hours_and_weekdays(raw):
    hours = {5: "Night", 6: "Morning", 11: "Morning", 12: "Afternoon", 16: "Afternoon",
             17: "Evening", 21: "Evening", 22: "Night"}
    days = {"2024-01-06": (True, "Saturday"), "2024-01-07": (True, "Sunday"),
            "2024-01-08": (False, "Monday")}
    trips = [trip(trip_id=str(h), pickup_datetime=f"2024-01-08 {h:02d}:00:00") for h in hours]
    trips += [trip(trip_id=d, pickup_datetime=f"{d} 10:00:00") for d in days]
    rows = {r.trip_id: r for r in features.engineer_features(raw(*trips)).collect()}
    assert {h: rows[str(h)].time_of_day for h in hours} == hours
    assert {d: (rows[d].is_weekend, rows[d].day_of_week) for d in days} == days


def test_division_by_zero_gives_null(raw):
    row = features.engineer_features(raw(trip(fare_amount=0.0, trip_distance_miles=0.0))).first()
    assert row.fare_per_mile is None and row.tip_percentage is None and row.avg_speed_mph == 0.0


def test_rounding_is_half_up_on_the_decimal_text(spark):
    values = spark.createDataFrame([(2.675, 1.005, 2.5, -2.5)], "a double, b double, c double, d double")
    rounded = values.select(F.round("a", 2), F.round("b", 2), F.round("c", 0), F.round("d", 0))
    assert tuple(rounded.first()) == (2.68, 1.01, 3.0, -3.0)


@pytest.mark.parametrize("digits", [1, 2])
def test_rounded_equals_round_to_the_bit(spark, digits):
    draw = random.Random(digits)
    halves = [(n + 0.5) / 10**digits for n in range(-3000, 3000)]
    near = [math.nextafter(x, side) for x in halves for side in (-math.inf, math.inf)]
    spread = [draw.uniform(-1, 1) * 10 ** draw.randint(-12, 20) for _ in range(20000)]
    odd = [0.0, -0.0, -0.001, 5e-324, 1.7e308, 1e9, -1e9, 999999999.995, math.nan, math.inf, -math.inf, None]
    values = spark.createDataFrame([(x,) for x in (*halves, *near, *spread, *odd)], "x double")
    pairs = values.select(tc.rounded(F.col("x"), digits).alias("fast"), F.round("x", digits).alias("slow"))
    # As text, so that NaN equals NaN and 0.0 is not -0.0.
    assert pairs.where(~F.col("fast").cast("string").eqNullSafe(F.col("slow").cast("string"))).collect() == []


def test_month_label_and_day_type(spark):
    frame = spark.createDataFrame([(2023, 1, True), (2023, 12, False)], "y int, m int, w boolean")
    rows = frame.select(tc.month_label("y", "m").alias("l"), tc.day_type("w").alias("d")).collect()
    assert rows == [Row(l="Jan 2023", d="Weekend"), Row(l="Dec 2023", d="Weekday")]


def test_null_ids_collapse_count_and_drop(raw):
    trips = raw(trip(), trip(trip_id=None), trip(trip_id=None, fare_amount=5.0), trip(tip_amount=0.5))
    assert quality.dedupe(trips).count() == 2
    report = quality.quality_report(trips).first()
    assert (report.total_records, report.null_trip_id, report.duplicate_ids) == (4, 2, 2)
    assert (report.clean_records, report.rejected_records) == (1, 3)
    clean = quality.clean_trips(trips).collect()
    assert [(row.trip_id, row.tip_amount) for row in clean] == [("a", 0.5)]


def test_dedupe_goes_before_the_range_filters(raw):
    """The survivor sorts first and is invalid, so the valid copy must not come back."""
    trips = raw(
        trip(pickup_datetime="2024-01-01 00:00:00", fare_amount=-1.0),
        trip(pickup_datetime="2024-01-02 00:00:00"),
        trip(trip_id="b", pickup_datetime=None, fare_amount=-1.0),
        trip(trip_id="b", pickup_datetime="2024-01-02 00:00:00"),
    )
    assert [row.trip_id for row in quality.clean_trips(trips).collect()] == ["b"]
    assert quality.quality_report(trips).first().clean_records == 1


def test_validity_of_null_nan_and_zero(raw):
    trips = raw(
        trip(trip_id="nan", fare_amount=NAN),
        trip(trip_id="null", fare_amount=None),
        trip(trip_id="zero", trip_distance_miles=0.0),
        trip(trip_id="no pickup", pickup_datetime=None),
    )
    assert {r.trip_id for r in quality.clean_trips(trips).collect()} == {"nan", "no pickup"}
    report = quality.quality_report(trips).first()
    assert (report.invalid_fare, report.invalid_distance, report.null_fare_amount) == (0, 1, 1)
    assert (report.null_pickup_datetime, report.clean_records) == (1, 2)


def test_report_of_no_rows(raw):
    report = quality.quality_report(raw()).first().asDict()
    assert set(report.values()) == {0}


def test_both_reports_agree(raw):
    trips = raw(trip(), trip(), trip(trip_id=None), trip(trip_id="b", fare_amount=-1.0))
    whole, counts = quality.quality_report(trips).first(), quality.raw_counts(trips).first()
    assert {name: whole[name] for name in counts.asDict()} == counts.asDict()


def test_fence_removes_the_outlier(spark):
    values = spark.createDataFrame([(float(v),) for v in [*range(1, 11), 100]], "x double")
    (fence,) = outliers.compute_fences(values, ["x"], "exact")
    assert (fence.q1, fence.q3, fence.lower, fence.upper) == (3.0, 9.0, -6.0, 18.0)
    kept = outliers.remove_outliers(values, ["x"], "exact").collect()
    assert sorted(r.x for r in kept) == [float(v) for v in range(1, 11)]
    report = outliers.outlier_report(values, ["x"], "exact").first()
    assert (report.rows_before, report.rows_after, report.rows_removed) == (11, 10, 1)


@pytest.mark.parametrize("mode", ["approx", "exact"])
def test_fence_skips_empty_columns_and_drops_null_and_nan(spark, mode):
    rows = [(None, 1.0), (None, 2.0), (None, NAN), (None, None), (None, 3.0)]
    frame = spark.createDataFrame(rows, "gone double, x double")
    fences = outliers.compute_fences(frame, ["gone", "x"], mode)
    assert [fence.active for fence in fences] == [False, True]
    assert [fence.rows_before for fence in fences] == [5, 5]
    assert sorted(r.x for r in outliers.apply_fences(frame, fences).collect()) == [1.0, 2.0, 3.0]


def test_fences_are_sequential(spark):
    """The second column's bounds must ignore rows the first fence removed."""
    rows = [(float(v), 1.0 + v / 10) for v in range(1, 11)] + [(1000.0, 500.0), (2000.0, 600.0)]
    frame = spark.createDataFrame(rows, "a double, b double")
    fences = outliers.compute_fences(frame, ["a", "b"], "exact")
    assert [fence.rows_before for fence in fences] == [12, 10]
    assert fences[1].q3 < 3


def test_unknown_fence_mode(spark):
    with pytest.raises(ValueError):
        outliers.compute_fences(spark.range(1), ["id"], "guess")


def test_null_boroughs_share_an_average(spark):
    rows = [(None, 10.0, 1.0), (None, 20.0, 2.0), ("Queens", 5.0, 1.0)]
    frame = spark.createDataFrame(
        rows, "pickup_borough string, fare_amount double, trip_distance_miles double"
    )
    result = {(r.pickup_borough, r.fare_amount): r for r in metrics.add_borough_metrics(frame).collect()}
    assert result[(None, 10.0)].borough_avg_fare == 15.0
    assert result[(None, 20.0)].fare_vs_borough_avg == 5.0
    assert result[("Queens", 5.0)].borough_avg_distance == 1.0


def test_topk_breaks_ties_by_key(spark):
    rows = [("b", "x", 1.0), ("a", "x", 1.0), ("a", "y", 1.0), ("c", "z", 1.0), ("c", "z", 1.0)]
    frame = spark.createDataFrame(rows, "pickup_borough string, dropoff_borough string, fare_amount double")
    top = kpis.kpi(frame, "kpi_od_pairs_top10").collect()
    assert [(r.pickup_borough, r.dropoff_borough) for r in top] == [
        ("c", "z"), ("a", "x"), ("a", "y"), ("b", "x")]


def test_report_order(spark, sf_dir):
    from tripmill.checks.tables import trip_tables

    final = trip_tables(spark, sf_dir).final
    for name, column, falling in [
        ("kpi_borough", "total_revenue_usd", True),
        ("kpi_peak_hour", "pickup_hour", False),
        ("kpi_payment", "trip_count", True),
        ("kpi_weekend", "is_weekend", False),
    ]:
        values = [row[column] for row in kpis.kpi(final, name).collect()]
        assert values == sorted(values, reverse=falling), name


def test_final_columns_and_types(spark, sf_dir):
    from tripmill.checks.tables import trip_tables

    final = trip_tables(spark, sf_dir).final
    assert final.columns == FINAL_SCHEMA.names and len(final.columns) == 24
    assert isinstance(final.first().pickup_datetime, dt.datetime)
