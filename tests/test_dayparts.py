"""Day parts: a filter on the calendar prunes the fact, and no trip is lost."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from faregrid.functions.measures import Measure
from faregrid.plans import dayparts, gold
from faregrid.plans.jobs import FACT_PARTITIONS, Lake
from faregrid.sources import readers

FARE = Measure("fare_amount")
# day, drop, fare: a late trip, two drops of one day, a day outside the calendar, drops of no month
TRIPS = [
    (20240105, 2024, 1, 10.0),
    (20240106, 2024, 1, 11.0),
    (20240106, 2024, 2, 12.0),
    (20240203, 2024, 1, 13.0),
    (20240309, 2024, 3, 14.0),
    (20240310, 2024, None, 15.0),
    (20240311, None, None, 16.0),
    (20250101, 2024, 3, 17.0),
    (None, 2024, 3, 18.0),
    (20240106, 2024, 2, None),
]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    fact = spark.createDataFrame(TRIPS, "date_key int, year int, month int, fare_amount double")
    lake.write(fact, "gold/fact_trips_yellow", FACT_PARTITIONS)
    calendar = gold.calendar(readers.calendar_range(spark, "2024-01-01", "2024-12-31"))
    lake.write(calendar, "gold/dim_time")
    dayparts.day_parts_job(spark, lake, "fact_trips_yellow")
    return lake


def tables(spark, lake):
    names = ("fact_trips_yellow", "fact_trips_yellow_days", "dim_time")
    return [lake.read(spark, f"gold/{n}") for n in names]


def test_day_parts_name_each_partition_of_a_day_once(spark, lake):
    rows = lake.read(spark, "gold/fact_trips_yellow_days").collect()
    got = Counter((r["date_key"], r["part_year"], r["part_month"]) for r in rows)
    want = {t[:3] for t in TRIPS if None not in t[:3] and t[0] // 10000 == 2024}
    assert set(got) == want and set(got.values()) == {1}


@pytest.mark.parametrize(
    "days", ["is_weekend", "month = 1", "quarter = 1 AND NOT is_weekend", "day > 40", "true"]
)
def test_trips_of_days_equal_the_plain_join(spark, lake, days):
    fact, parts, calendar = tables(spark, lake)
    got = dayparts.trips_of_days(fact, parts, calendar, F.expr(days), ["day_name"], [FARE])
    plain = (
        fact.drop(*FACT_PARTITIONS)
        .join(calendar.filter(days), "date_key")
        .groupBy("day_name")
        .agg(F.count("*").alias("n"), F.sum("fare_amount").alias("fares"))
    )
    assert {(r[0], r[1]) for r in got.select("day_name", "rows__n").collect()} == {
        (r["day_name"], r["n"]) for r in plain.collect()
    }


def test_a_calendar_filter_prunes_the_partitions_read(spark, lake, plan_text):
    fact, parts, _ = tables(spark, lake)
    found = dayparts.tally_of_days(fact, parts, F.expr("is_weekend AND month = 3"), ["day_name"], [FARE])
    assert "dynamicpruning" in plan_text(found)
    assert [r["rows__n"] for r in found.collect()] == [1]
    scans, todo = [], [found._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            scans.append(node)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    read = {
        s.metrics().apply("numPartitions").value() for s in scans if s.metrics().contains("numPartitions")
    }
    assert read == {1}  # of five, the one that holds the Saturday in March


def test_no_trips_and_no_days(spark, lake):
    fact, parts, calendar = tables(spark, lake)
    nothing = fact.limit(0)
    for trips, days in ((nothing, parts), (fact, parts.limit(0))):
        got = dayparts.tally_of_days(trips, days, F.lit(True), ["day_name"], [FARE])
        assert got.count() == 0
    assert dayparts.day_parts(nothing, calendar).count() == 0
