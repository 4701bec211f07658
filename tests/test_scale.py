"""Plans that must hold when the data is large."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faregrid.operators import lookups
from faregrid.plans import gold, questions, silver, summary
from faregrid.session import staged
from faregrid.sources import sinks
from workload import adapters, inputs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def weather_join(spark):
    kept = silver.metered_silver(adapters.metered_bronze(spark, SF_DIR)).kept
    return lookups.with_weather(kept, staged(inputs.hourly(spark, SF_DIR), "weather"))


def test_small_stored_weather_is_broadcast(spark, plan_text):
    assert "BroadcastHashJoin LeftOuter" in plan_text(weather_join(spark))


def test_large_weather_falls_back_to_a_shuffle(spark, plan_text, no_broadcast):
    plan = plan_text(weather_join(spark))
    assert "SortMergeJoin LeftOuter" in plan and "Broadcast" not in plan


def test_results_do_not_depend_on_the_join_strategy(spark, no_broadcast):
    fact, zones = inputs.metered_fact(spark, SF_DIR), adapters.zones(spark, SF_DIR)
    shuffled = summary.borough_summary(fact, zones).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert sorted(map(str, shuffled)) == sorted(map(str, summary.borough_summary(fact, zones).collect()))


def plans_without_nested_loops(spark):
    fact, zones = inputs.metered_fact(spark, SF_DIR), adapters.zones(spark, SF_DIR)
    hail = inputs.ride_hail_fact(spark, SF_DIR)
    both = gold.both_facts(fact, hail)
    yield summary.monthly_trips(fact, hail)
    yield summary.quarterly_recovery(fact, zones)
    yield summary.weather_summary(fact, zones)
    yield questions.trips_between_boroughs(fact, zones)
    yield questions.top_zones_of_borough(fact, zones, "ASIA")
    yield questions.operator_trips_by_year(both, ("Uber", "yellow"))
    yield questions.month_in_two_years(fact, zones, 4, (1997, 1998))
    yield silver.stream_silver(inputs.envelope(spark, SF_DIR)).kept


def test_no_cartesian_joins_and_no_python(spark, plan_text):
    for df in plans_without_nested_loops(spark):
        plan = plan_text(df)
        for banned in ("CartesianProduct", "NestedLoop", "Python", "ArrowEval"):
            assert banned not in plan


def test_top_k_is_not_a_full_sort(spark, plan_text):
    fact, zones = inputs.metered_fact(spark, SF_DIR), adapters.zones(spark, SF_DIR)
    assert "TakeOrderedAndProject" in plan_text(questions.top_zones_of_borough(fact, zones, "ASIA"))


def test_month_filters_reach_the_partitions_of_the_fact(spark, plan_text, tmp_path):
    path = str(tmp_path / "fact")
    sinks.replace_all(inputs.metered_fact(spark, SF_DIR), path, ("year", "month"))
    fact, zones = spark.read.parquet(path), adapters.zones(spark, SF_DIR)
    plan = plan_text(questions.busiest_borough(fact, zones, 1998, 4))
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan
    # two columns are enough for a count per zone
    assert "ReadSchema: struct<pickup_location_id:bigint>" in plan


def test_partitioned_writes_are_rebalanced(spark, tmp_path):
    """One hot month and a few cold ones: whole rows, few files per month."""
    rows = spark.range(30_000).select(
        "id", F.lit(2020).alias("year"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 12 + 1).alias("month")
    )
    path = str(tmp_path / "t")
    sinks.replace_all(rows.repartition(16), path, ("year", "month"))
    stored = spark.read.parquet(path)
    assert stored.count() == 30_000
    assert len(stored.inputFiles()) <= 12 * 2
