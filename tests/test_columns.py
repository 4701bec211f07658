"""Edges of the derived columns."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faregrid.functions import labels, timeparts, tripmath

MONDAY, SATURDAY = "2024-01-08", "2024-01-06"


def rush(spark, moments, profile):
    rows = spark.createDataFrame([(m,) for m in moments], "m string").withColumn(
        "t", F.col("m").try_cast("timestamp_ntz")
    )
    timed = timeparts.with_time_features(rows, "t", profile)
    return [(r.is_rush_hour, r.is_weekend) for r in timed.collect()]


def test_rush_hour_edges(spark):
    clock = ["06:59", "07:00", "09:59", "10:00", "15:59", "16:00", "16:59", "17:00", "19:59", "20:00"]
    monday = [f"{MONDAY} {c}:00" for c in clock]
    lake = [flag for flag, _ in rush(spark, monday, timeparts.LAKE_RUSH)]
    stream = [flag for flag, _ in rush(spark, monday, timeparts.STREAM_RUSH)]
    assert lake == [False, True, True, False, False, True, True, True, True, False]
    assert stream == [False, True, True, False, False, False, False, True, True, False]


def test_rush_hour_on_weekends_and_without_time(spark):
    at_eight = [f"{SATURDAY} 08:00:00"]
    assert rush(spark, at_eight, timeparts.LAKE_RUSH) == [(False, True)]
    assert rush(spark, at_eight, timeparts.STREAM_RUSH) == [(True, True)]
    assert rush(spark, ["bad"], timeparts.LAKE_RUSH) == [(None, None)]
    assert rush(spark, ["bad"], timeparts.STREAM_RUSH) == [(False, False)]


@pytest.mark.parametrize(
    ("celsius", "label"),
    [
        (-0.1, "Freezing (<0C)"),
        (0.0, "Cold (0-10C)"),
        (9.9, "Cold (0-10C)"),
        (10.0, "Mild (10-20C)"),
        (20.0, "Warm (20-30C)"),
        (30.0, "Hot (>30C)"),
        (None, "Hot (>30C)"),
    ],
)
def test_temperature_buckets(spark, celsius, label):
    rows = spark.createDataFrame([(celsius,)], "c double")
    assert rows.select(labels.temperature_bucket(F.col("c"))).first()[0] == label


def test_rain_buckets_and_named_missing_bucket(spark):
    values = [(0.0,), (0.1,), (1.9,), (2.0,), (9.9,), (10.0,), (None,)]
    rows = spark.createDataFrame(values, "mm double")
    found = [r[0] for r in rows.select(labels.rain_bucket(F.col("mm"))).collect()]
    assert found == [
        "No rain", "Light rain", "Light rain", "Moderate rain", "Moderate rain", "Heavy rain",
        "Heavy rain",
    ]
    named = rows.select(labels.rain_bucket(F.col("mm"), "No reading")).collect()
    assert named[-1][0] == "No reading"


def test_condition_needs_known_temperature_for_snow(spark):
    rows = spark.createDataFrame(
        [(1.0, 0.0), (1.0, 0.1), (0.0, -5.0), (1.0, None), (None, -5.0)], "mm double, c double"
    )
    found = rows.select(labels.weather_condition(F.col("mm"), F.col("c"))).collect()
    assert [r[0] for r in found] == ["Snow", "Rain", "Clear", "Rain", "Clear"]


def test_codes(spark):
    rows = spark.createDataFrame(
        [("HV0002", 1, "Queens"), ("HV0005", 4, "EWR"), ("HV9", 5, None), (None, None, "Bronx")],
        "l string, p int, b string",
    )
    found = rows.select(
        labels.company(F.col("l")), labels.payment_label(F.col("p")), labels.borough_ordinal(F.col("b"))
    ).collect()
    assert [tuple(r) for r in found] == [
        ("Juno", "Credit Card", 3),
        ("Lyft", "Dispute", 6),
        ("Unknown", "Unknown", 6),
        ("Unknown", "Unknown", 4),
    ]


def test_trip_math(spark):
    rows = spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 10, 20), 10.0, 4.0, 1.0),
            (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), 0.0, 0.0, 5.0),
            (None, dt.datetime(2024, 1, 2), None, None, None),
        ],
        "a timestamp_ntz, b timestamp_ntz, fare double, miles double, tip double",
    )
    found = rows.select(
        tripmath.duration_minutes(F.col("a"), F.col("b")),
        tripmath.fare_per_mile(F.col("fare"), F.col("miles")),
        tripmath.tip_percent(F.col("tip"), F.col("fare")),
    ).collect()
    assert [tuple(r) for r in found] == [(10.33, 2.5, 10.0), (1440.0, None, 0.0), (None, None, 0.0)]


def test_rounding_is_half_up_on_decimal_text(spark):
    rows = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (5.595,)], "x double")
    assert [r[0] for r in rows.select(F.round("x", 2)).collect()] == [1.01, 2.68, 0.13, 5.6]


def test_month_names_and_parts_of_day(spark):
    months = spark.range(0, 14).select(timeparts.month_name(F.col("id").cast("int"))).collect()
    names = [r[0] for r in months]
    assert names[0] is None and names[13] is None
    assert names[1] == "January" and names[12] == "December"
    hours = spark.range(0, 24).select(timeparts.part_of_day(F.col("id"))).collect()
    parts = [r[0] for r in hours]
    assert [parts.count(p) for p in ("Morning", "Afternoon", "Evening", "Night")] == [6, 5, 4, 9]
    assert parts[5] == "Night" and parts[6] == "Morning" and parts[21] == "Night"


def test_date_key_equals_formatted_date(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'2019-01-01', DATE'2025-12-31', INTERVAL 1 DAY)) AS d"
    )
    wrong = days.filter(
        timeparts.date_key(F.col("d")) != F.date_format("d", "yyyyMMdd").cast("int")
    )
    assert days.count() == 2557 and wrong.count() == 0
