"""Answers derived from summary rows, against published figures and by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from faregrid.plans import answers, questions

MONTHLY = (
    "year int, month int, trips bigint, avg_fare double, avg_tip double, avg_distance double, "
    "taxi_type string"
)


def monthly(spark, rows):
    return spark.createDataFrame(rows, MONTHLY)


def test_month_by_month_and_same_month(spark):
    rows = monthly(
        spark,
        [
            (2020, 4, 210610, 10.75, 1.5, 2.0, "Yellow Taxi"),
            (2020, 1, 6204500, 12.57, 2.2, 2.8, "Yellow Taxi"),
            (2020, 1, 9, 1.0, 1.0, 1.0, "Uber"),
            (2024, 1, 2757101, 18.57, 3.47, 3.25, "Yellow Taxi"),
            (2025, 1, 2850384, 18.06, 3.5, 3.14, "Yellow Taxi"),
        ],
    )
    assert [tuple(r) for r in answers.month_by_month(rows, 2020).collect()] == [
        (1, 6204500, 12.57),
        (4, 210610, 10.75),
    ]
    assert answers.same_month(rows, 1, (2024, 2025)).count() == 2


def test_unweighted_means_of_rounded_averages(spark):
    """The tie 5.595 rounds up: the mean is exact, not a float sum."""
    rows = monthly(
        spark,
        [
            (2019, 1, 10, 5.59, 1.90, 1.0, "Yellow Taxi"),
            (2019, 2, 99, 5.60, 1.91, 1.0, "Yellow Taxi"),
        ],
    )
    found = answers.yearly_tips(rows).first()
    assert (found.total_trips, found.avg_fare, found.avg_tip) == (109, 5.6, 1.91)
    assert found.tip_pct == 34.0


def test_quarter_recovery_fills_every_column(spark):
    rows = spark.createDataFrame(
        [
            (2019, 3, "Queens", 1408153),
            (2020, 3, "Queens", 130705),
            (2021, 3, "Queens", 612047),
            (2021, 2, "Queens", 5),
            (2019, 3, None, 10976),
        ],
        "year int, quarter int, borough string, trips bigint",
    )
    found = {r.borough: r for r in answers.quarter_recovery(rows, 3, (2019, 2020, 2021)).collect()}
    assert (found["Queens"].pct_drop_2020, found["Queens"].pct_recovery_2021) == (90.7, 43.5)
    assert found[None].trips_q3_2019 == 10976 and found[None].trips_q3_2020 is None


def test_fleet_share(spark):
    rows = spark.createDataFrame(
        [
            (2024, 36065342, "Yellow Taxi"),
            (2024, 179101127, "Uber"),
            (2024, 60342594, "Lyft"),
            (2018, 5, "Yellow Taxi"),
        ],
        "year int, trips bigint, taxi_type string",
    )
    found = {r.year: r for r in answers.fleet_share(rows).collect()}
    assert (found[2024].total_trips, found[2024].rideshare_pct) == (275509063, 86.9)
    assert (found[2018].rideshare_trips, found[2018].rideshare_pct) == (0, 0.0)


def test_top_zones_order_ties_by_name(spark):
    rows = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "zone string, trips bigint")
    assert [r.zone for r in answers.top_zones(rows, 2).collect()] == ["c", "a"]


def test_period_collapse(spark):
    fact = spark.range(1000).select(
        F.lit(2020).alias("year"), F.when(F.col("id") < 966, 1).otherwise(4).alias("month")
    )
    found = answers.period_collapse(fact, (2020, 1), (2020, 4)).first()
    assert (found.trips_before, found.trips_after, found.collapse_pct) == (966, 34, 96.5)
    nothing = answers.period_collapse(fact, (1999, 1), (2020, 4)).first()
    assert nothing.collapse_pct is None


def months(spark, counts):
    rows = [(2020 + (m - 1) // 12, (m - 1) % 12 + 1) for m, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "year int, month int")


def test_recovery_month(spark):
    fact = months(spark, {1: 10, 4: 1, 5: 4, 6: 9, 14: 10})
    found = questions.recovery_month(fact, (2020, 1), (2020, 4), 0.9).first()
    assert (found.recovery_year, found.recovery_month, found.months_taken) == (2020, 6, 2)
    full = questions.recovery_month(fact, (2020, 1), (2020, 4), 1.0).first()
    assert (full.recovery_year, full.recovery_month, full.months_taken) == (2021, 2, 10)
    never = questions.recovery_month(fact, (2020, 1), (2020, 4), 2.0).first()
    assert never.recovery_year is None and never.base_trips == 10
