"""Row rules, the split, the report, table checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from faregrid.operators import quality

GOOD = {
    "fare_amount": 10.0,
    "trip_distance": 1.0,
    "passenger_count": 1.0,
    "tpep_pickup_datetime": dt.datetime(2024, 1, 1),
    "tpep_dropoff_datetime": dt.datetime(2024, 1, 1, 1),
    "PULocationID": 1,
    "DOLocationID": 265,
    "total_amount": 12.0,
}
SCHEMA = (
    "fare_amount double, trip_distance double, passenger_count double, "
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "PULocationID bigint, DOLocationID bigint, total_amount double"
)
BOUNDS = {
    "fare_amount": (0.0, 500.0, 0.01),
    "trip_distance": (0.0, 100.0, 0.01),
    "passenger_count": (1.0, 6.0, 1.0),
    "PULocationID": (1, 265, 1),
    "DOLocationID": (1, 265, 1),
    "total_amount": (0.0, 1000.0, 0.01),
}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in GOOD) for r in rows], SCHEMA)


def test_both_bounds_and_one_step_outside(spark):
    inside, outside = [GOOD], []
    for column, (low, high, step) in BOUNDS.items():
        inside += [{**GOOD, column: low}, {**GOOD, column: high}]
        outside += [{**GOOD, column: low - step}, {**GOOD, column: high + step}]
    rules = quality.METERED_RULES
    assert quality.passed(frame(spark, inside), rules).count() == len(inside)
    assert quality.passed(frame(spark, outside), rules).count() == 0
    assert quality.failed(frame(spark, outside), rules).count() == len(outside)


def test_missing_inputs_under_both_policies(spark):
    rows = frame(spark, [{**GOOD, column: None} for column in GOOD] + [GOOD])
    rules = quality.METERED_RULES
    assert quality.passed(rows, rules).count() == 1
    # every row lands in exactly one branch
    assert quality.failed(rows, rules).count() == len(GOOD)
    # a missing time is a definite failure, any other missing input stays undecided
    assert quality.failed(rows, rules, quality.NULL_UNKNOWN).count() == 2
    report = quality.report(rows, rules, quality.NULL_UNKNOWN).first()
    assert (report.total_rows, report.passed_rows, report.failed_rows) == (9, 1, 2)
    assert report.undecided_rows == 6


def test_nan_fails_ranges(spark):
    rows = frame(spark, [{**GOOD, "fare_amount": float("nan")}])
    assert quality.passed(rows, quality.METERED_RULES).count() == 0


def test_report_is_one_pass_and_conserves_rows(spark, plan_text):
    rows = frame(spark, [GOOD, {**GOOD, "fare_amount": 501.0}, {**GOOD, "passenger_count": None}])
    df = quality.report(rows, quality.METERED_RULES)
    report = df.first()
    assert report.passed_rows + report.failed_rows == report.total_rows == 3
    assert (report.failed_valid_fare, report.failed_valid_passengers) == (1, 1)
    assert report.pass_rate_pct == 33.3
    assert plan_text(df).count("Exchange") <= 4  # one exchange, listed in tree and details


def test_dead_letters_keep_flags_and_time(spark):
    rows = frame(spark, [{**GOOD, "fare_amount": -1.0}])
    letter = quality.failed(rows, quality.METERED_RULES, stamp="failure_timestamp").first()
    assert letter.valid_fare is False and letter.valid_total is True
    assert letter.failure_timestamp is not None


def test_ride_hail_rejects_epoch_dropoff(spark):
    rows = spark.createDataFrame(
        [
            (1.0, 1.0, 60, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), 5, 5, 1.0),
            (1.0, 1.0, 60, dt.datetime(2024, 1, 1), dt.datetime(1970, 1, 1), 5, 5, 1.0),
            (1.0, 1.0, 60, dt.datetime(2024, 1, 1), dt.datetime(1971, 1, 1), 5, 5, 1.0),
        ],
        "base_passenger_fare double, trip_miles double, trip_time bigint, "
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
        "PULocationID bigint, DOLocationID bigint, driver_pay double",
    )
    flagged = quality.with_flags(rows, quality.RIDE_HAIL_RULES).collect()
    assert [r.valid_dropoff for r in flagged] == [True, False, False]


def test_table_checks(spark):
    rows = spark.createDataFrame([(1, "Clear"), (1, "Hail"), (None, None)], "k int, c string")
    found = quality.run_checks(
        {
            "t": (
                rows,
                [
                    quality.NotNull("k"),
                    quality.Unique("k"),
                    quality.AcceptedValues("c", ("Clear", "Rain", "Snow")),
                ],
            )
        }
    )
    assert {(r.check_name, r.failing_rows, r.passed) for r in found.collect()} == {
        ("not_null", 1, False),
        ("unique", 1, False),
        ("accepted_values", 1, False),
    }


def test_passed_filter_reaches_the_scan(spark, plan_text, tmp_path):
    path = str(tmp_path / "bronze")
    frame(spark, [GOOD]).write.parquet(path)
    plan = plan_text(quality.passed(spark.read.parquet(path), quality.METERED_RULES).select(F.lit(1)))
    assert "GreaterThanOrEqual(fare_amount,0.0)" in plan
    assert "LessThanOrEqual(total_amount,1000.0)" in plan
