"""Summaries: exact sums, cells against direct rollups, conserved totals, skew."""

from __future__ import annotations

from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from faregrid.functions.measures import (
    FARE,
    TIP,
    exact_mean,
    exact_sum,
    mean,
    mean_ratio_percent,
    total,
)
from faregrid.operators.tally import merge, present, tally
from faregrid.plans import summary

FACT_ROWS = 40_000


@pytest.fixture(scope="module")
def fact(spark):
    """Trips of which a third start in one zone, some without weather or with NaN tips."""
    n = F.col("id")
    return spark.range(FACT_ROWS).select(
        (2019 + n % 3).cast("int").alias("year"),
        (n % 12 + 1).cast("int").alias("month"),
        (n * 31 % 24).cast("int").alias("pickup_hour"),
        (n % 7 < 2).alias("is_weekend"),
        (n % 5 == 0).alias("is_rush_hour"),
        F.when(n % 3 == 0, 132).otherwise(n % 265 + 1).alias("pickup_location_id"),
        (n % 5 + 1).alias("payment_type"),
        (F.col("id") * 13 % 5000 / 100.0).alias("fare_amount"),
        F.when(n % 1000 == 1, float("nan")).otherwise(n % 700 / 100.0).alias("tip_amount"),
        (n * 17 % 9000 / 100.0).alias("total_amount"),
        (n % 333 / 1000.0).alias("trip_distance"),
        F.when(n % 9 != 0, n % 50 - 10.0).alias("weather_temp_c"),
        F.when(n % 9 != 0, n % 13 * 1.0).alias("weather_precip_mm"),
    )


@pytest.fixture(scope="module")
def zones(spark):
    n = F.col("id")
    return spark.range(1, 264).select(
        n.alias("location_id"),
        F.when(n % 50 != 0, F.concat(F.lit("B"), (n % 6).cast("string"))).alias("borough"),
        F.concat(F.lit("Z"), n.cast("string")).alias("zone"),
        F.lit("s").alias("service_zone"),
    )


@pytest.fixture(scope="module")
def ride_hail(spark, fact):
    return fact.withColumn(
        "company", F.when(F.col("payment_type") < 4, "Uber").otherwise("Lyft")
    ).filter("pickup_hour > 5")


def equal(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cells_give_the_same_tables_as_direct_rollups(spark, fact, ride_hail, zones):
    cells = summary.summary_cells(fact).cache()
    stored = summary.all_summaries(cells, summary.ride_hail_cells(ride_hail), zones)
    direct = {
        "monthly_trips": summary.monthly_trips(fact, ride_hail),
        "yearly_summary": summary.yearly_summary(fact, ride_hail),
        "hourly_summary": summary.hourly_summary(fact),
        "payment_summary": summary.payment_summary(fact),
        "borough_summary": summary.borough_summary(fact, zones),
        "zone_summary": summary.zone_summary(fact, zones),
        "quarterly_recovery": summary.quarterly_recovery(fact, zones),
        "weather_summary": summary.weather_summary(fact, zones),
    }
    assert set(stored) == set(direct)
    for name, df in direct.items():
        equal(stored[name], df)
    cells.unpersist()


def test_trips_are_conserved(fact, zones):
    located = fact.join(zones, F.col("pickup_location_id") == F.col("location_id")).count()

    def trips(df):
        return df.agg(F.sum("trips")).first()[0]

    assert trips(summary.monthly_metered(fact)) == FACT_ROWS
    assert trips(summary.hourly_summary(fact)) == FACT_ROWS
    assert trips(summary.payment_summary(fact)) == FACT_ROWS
    assert trips(summary.borough_summary(fact, zones)) == located
    assert trips(summary.zone_summary(fact, zones)) == located
    assert trips(summary.weather_summary(fact, zones)) == located
    assert trips(summary.quarterly_recovery(fact, zones)) == located
    assert located < FACT_ROWS  # two zones are not in the dimension


def test_missing_borough_is_a_group(fact, zones):
    rows = summary.borough_summary(fact, zones).filter("borough IS NULL")
    # all trips of 2019 start in the hot zone, which has a borough
    assert sorted(r.year for r in rows.collect()) == [2020, 2021]


def test_missing_weather_has_its_own_bucket_on_request(fact, zones):
    named = summary.weather_summary(fact, zones, unmatched="No reading")
    found = named.filter("temp_bucket = 'No reading'").agg(F.sum("trips")).first()[0]
    assert found > 0
    assert summary.weather_summary(fact, zones).filter("temp_bucket = 'No reading'").count() == 0


def test_sums_do_not_depend_on_partitions(spark):
    rows = spark.range(30_000).select((F.col("id") % 977 / 100.0).alias("fare_amount"))
    found = {
        tuple(
            present(
                tally(rows.repartition(parts), [], [FARE]),
                [],
                {"mean": mean(FARE, 6), "total": total(FARE, 2)},
            ).first()
        )
        for parts in (1, 3, 16)
    }
    assert len(found) == 1


def test_merge_equals_tally(spark, fact):
    fine = tally(fact, ["year", "month", "pickup_hour"], [FARE, TIP])
    equal(merge(fine, ["year"], [FARE, TIP]), tally(fact, ["year"], [FARE, TIP]))


def test_ratio_of_means_edges(spark):
    rows = spark.createDataFrame(
        [(1, 0.0, 1.0), (2, 10.0, 1.0), (2, 20.0, None), (3, None, None)],
        "k int, fare_amount double, tip_amount double",
    )
    found = present(
        tally(rows, ["k"], [FARE, TIP]),
        ["k"],
        {"pct": mean_ratio_percent(TIP, FARE), "fare": mean(FARE), "tip": mean(TIP)},
    )
    assert {tuple(r) for r in found.collect()} == {
        (1, None, 0.0, 1.0),
        (2, 6.67, 15.0, 1.0),
        (3, None, None, None),
    }


ODD = [0.01 * 0.07, 1e-19, 1.25e-19, -3e-19, 1e21, 7e20, 9e19, 123456789012.25, 5.5, -0.004, 1 / 3, 0.0]


def sums(df) -> tuple:
    return tuple(present(tally(df, [], [FARE]), [], {"s": exact_sum(FARE), "m": exact_mean(FARE)}).first())


def test_sums_of_all_sizes_are_exact_in_any_order(spark):
    for values in (ODD, ODD[:4], ODD[4:7], [1e21, -1e21, 2.5], [1e25], [9e19] * 4, [0.0007000000000000001] * 3):
        want = float(sum(Decimal(repr(v)) for v in values))
        for order in (values, values[::-1], sorted(values)):
            df = spark.createDataFrame([(v,) for v in order], "fare_amount double").repartition(3)
            have, mean_of = sums(df)
            assert have == pytest.approx(want, rel=4e-16, abs=0), (values, have, want)
            assert mean_of == have / len(values)


def test_limbs_are_the_digits_of_the_values(spark):
    df = spark.createDataFrame([(v,) for v in ODD], "fare_amount double")
    row = tally(df, [], [FARE]).first()
    with localcontext() as context:
        context.prec = 80
        limbs = sum(row[name] for name in FARE.limbs())
        assert limbs == sum(Decimal(repr(v)) for v in ODD)


def test_values_without_end_are_told_by_their_sign(spark):
    inf, nan = float("inf"), float("nan")
    for values, want in (
        ([1.0, inf], inf), ([1.0, -inf], -inf), ([inf, -inf], nan), ([nan, 2.0], 2.0), ([nan, None], None),
        ([1e300, 1.0], inf), ([-1.7e308, 1e-300], -inf),
    ):
        have, mean_of = sums(spark.createDataFrame([(v,) for v in values], "fare_amount double"))
        assert str(have) == str(want)
        assert mean_of is None if want is None else str(mean_of) == str(want)
    split = [spark.createDataFrame([(v,)], "fare_amount double") for v in (inf, -inf, 1e-19)]
    fine = tally(split[0], [], [FARE]).union(tally(split[1], [], [FARE])).union(tally(split[2], [], [FARE]))
    assert str(present(merge(fine, [], [FARE]), [], {"s": total(FARE)}).first()[0]) == "nan"


def test_values_are_not_cut_before_they_are_summed(spark):
    rows = spark.range(1000).select(F.lit(0.004).alias("fare_amount"))
    shown = {"total": total(FARE, 3), "mean": mean(FARE, 4)}
    assert tuple(present(tally(rows, [], [FARE]), [], shown).first()) == (4.0, 0.004)
    odd = spark.createDataFrame([(0.1 + 0.2,), (1 / 3,), (float("nan"),)], "fare_amount double")
    found = tally(odd, [], [FARE]).first()
    assert str(found[FARE.units]) == "0.633333333333333340" and found[FARE.seen] == 2


def test_fact_is_tallied_before_it_meets_the_dimension(fact, zones, plan_text):
    plan = plan_text(summary.borough_summary(fact, zones)).split("\n\n")[0]
    join, deepest = plan.index("Join"), plan.rindex("HashAggregate")
    assert deepest > join  # the lower aggregate is printed further down
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_one_scan_feeds_all_cells(spark, fact, tmp_path, plan_text):
    path = str(tmp_path / "fact")
    fact.write.parquet(path)
    plan = plan_text(summary.summary_cells(spark.read.parquet(path))).split("\n\n")[0]
    assert plan.count("Scan parquet") == 1 and plan.count("Expand") == 1
