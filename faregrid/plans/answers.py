"""Answer tables derived from the summary tables.

Where an answer is defined as the plain mean of already rounded averages, it
keeps that definition; ``trip_weighted`` gives the form weighted by trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.functions.measures import (
    FARE,
    TIP,
    TOTAL,
    Measure,
    exact_mean,
    exact_sum,
    mean,
    mean_ratio_percent,
    total,
    trips,
)
from faregrid.operators.tally import merge, present, tally
from faregrid.plans.summary import METERED_LABEL

TOP_ZONES = 20

AVG_FARE = Measure("avg_fare")
AVG_TIP = Measure("avg_tip")
AVG_TIP_PCT = Measure("avg_tip_pct")
REVENUE = Measure("total_revenue")


def _percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), digits)


def _means(df: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """Trips and the exact sums of rounded averages, one per summary row."""
    return df.groupBy(*keys).agg(
        F.sum("trips").alias("total_trips"),
        *[column for measure in measures for column in measure.tally_columns()],
    )


def month_by_month(monthly: DataFrame, year: int) -> DataFrame:
    """One year of the metered fleet, month by month."""
    return (
        monthly.filter((F.col("taxi_type") == METERED_LABEL) & (F.col("year") == year))
        .select("month", "trips", "avg_fare")
        .orderBy("month")
    )


def quarter_recovery(quarterly: DataFrame, quarter: int, years: tuple[int, int, int]) -> DataFrame:
    """One quarter of three years side by side: the fall and the way back, in percent."""
    base, low, later = years

    def of_year(year: int) -> Column:
        return F.sum(F.when(F.col("year") == year, F.col("trips")))

    names = {year: f"trips_q{quarter}_{year}" for year in years}
    wide = (
        quarterly.filter((F.col("quarter") == quarter) & F.col("year").isin(*years))
        .groupBy("borough")
        .agg(*[of_year(year).alias(name) for year, name in names.items()])
    )
    start = F.col(names[base])
    return wide.withColumns(
        {
            f"pct_drop_{low}": _percent(start - F.col(names[low]), start),
            f"pct_recovery_{later}": _percent(F.col(names[later]), start),
        }
    )


def fleet_share(yearly: DataFrame) -> DataFrame:
    """Both fleets per year and the ride-hail share."""
    metered = F.col("taxi_type") == METERED_LABEL
    wide = yearly.groupBy("year").agg(
        F.coalesce(F.sum(F.when(metered, F.col("trips"))), F.lit(0)).alias("yellow_trips"),
        F.coalesce(F.sum(F.when(~metered, F.col("trips"))), F.lit(0)).alias("rideshare_trips"),
    )
    return wide.withColumn(
        "total_trips", F.col("yellow_trips") + F.col("rideshare_trips")
    ).withColumn("rideshare_pct", _percent(F.col("rideshare_trips"), F.col("total_trips")))


def top_zones(zones: DataFrame, k: int = TOP_ZONES) -> DataFrame:
    """Busiest zones; equal counts are ordered by name."""
    return zones.orderBy(F.desc("trips"), "zone").limit(k)


def weather_impact(weather: DataFrame) -> DataFrame:
    rows = _means(weather, ["rain_bucket"], [AVG_FARE, AVG_TIP])
    return rows.select(
        "rain_bucket",
        "total_trips",
        mean(AVG_FARE).alias("avg_fare"),
        mean(AVG_TIP).alias("avg_tip"),
    )


def rush_hour(hourly: DataFrame) -> DataFrame:
    keys = ["is_rush_hour", "is_weekend"]
    rows = _means(hourly, keys, [AVG_FARE, AVG_TIP_PCT])
    return rows.select(
        *keys,
        "total_trips",
        mean(AVG_FARE).alias("avg_fare"),
        mean(AVG_TIP_PCT).alias("avg_tip_pct"),
    )


def payment_patterns(payments: DataFrame) -> DataFrame:
    rows = _means(payments, ["payment_label"], [AVG_FARE, AVG_TIP_PCT])
    return rows.select(
        "payment_label",
        "total_trips",
        mean(AVG_FARE).alias("avg_fare"),
        mean(AVG_TIP_PCT).alias("avg_tip_pct"),
    ).orderBy(F.desc("total_trips"), "payment_label")


def borough_revenue(boroughs: DataFrame) -> DataFrame:
    """Revenue and trips of all years; a zone without a borough is a group of its own."""
    rows = _means(boroughs, ["borough"], [AVG_FARE, REVENUE])
    return rows.select(
        "borough",
        "total_trips",
        exact_sum(REVENUE).alias("total_revenue"),
        mean(AVG_FARE).alias("avg_fare"),
    ).orderBy(F.desc("total_revenue"), "borough")


def same_month(monthly: DataFrame, month: int, years: tuple[int, int]) -> DataFrame:
    """One month of the metered fleet in two years."""
    return monthly.filter(
        (F.col("taxi_type") == METERED_LABEL)
        & (F.col("month") == month)
        & F.col("year").isin(*years)
    ).select("year", "month", "taxi_type", "trips", "avg_fare", "avg_tip", "avg_distance")


def yearly_tips(monthly: DataFrame) -> DataFrame:
    """Mean of the monthly averages; the tip share uses the unrounded means."""
    metered = monthly.filter(F.col("taxi_type") == METERED_LABEL)
    rows = _means(metered, ["year"], [AVG_FARE, AVG_TIP])
    share = F.try_divide(exact_mean(AVG_TIP), exact_mean(AVG_FARE)) * 100
    return rows.select(
        "year",
        "total_trips",
        mean(AVG_TIP).alias("avg_tip"),
        mean(AVG_FARE).alias("avg_fare"),
        F.round(share, 1).alias("tip_pct"),
    ).orderBy("year")


def trip_weighted(source: DataFrame, keys: Sequence[str], tallied: bool = False) -> DataFrame:
    """Trips, means, revenue and tip share per group, every trip counting once.

    Takes the fact, or cells that were tallied before; the measures have names of
    their own so that they are not taken for the unweighted answers.
    """
    measures = (FARE, TIP, TOTAL)
    rows = merge(source, keys, measures) if tallied else tally(source, keys, measures)
    return present(
        rows,
        keys,
        {
            "total_trips": trips(),
            "trip_avg_fare": mean(FARE),
            "trip_avg_tip": mean(TIP),
            "trip_tip_pct": mean_ratio_percent(TIP, FARE),
            "total_revenue": total(TOTAL, 0),
        },
    )


def period_collapse(fact: DataFrame, before: tuple[int, int], after: tuple[int, int]) -> DataFrame:
    """Trips of two (year, month) periods and the fall between them."""

    def in_period(period: tuple[int, int]) -> Column:
        return (F.col("year") == period[0]) & (F.col("month") == period[1])

    counts = fact.filter(in_period(before) | in_period(after)).agg(
        F.count_if(in_period(before)).alias("trips_before"),
        F.count_if(in_period(after)).alias("trips_after"),
    )
    fall = F.col("trips_before") - F.col("trips_after")
    return counts.withColumn("collapse_pct", _percent(fall, F.col("trips_before")))


def market_share(both: DataFrame, year: int) -> DataFrame:
    """Ride-hail share of all trips of one year, from the tagged union of the facts."""
    counts = both.filter(F.col("year") == year).agg(
        F.count_if(F.col("taxi_type") == "yellow").alias("yellow_trips"),
        F.count_if(F.col("taxi_type") == "fhvhv").alias("rideshare_trips"),
    )
    whole = F.col("yellow_trips") + F.col("rideshare_trips")
    return counts.withColumn("rideshare_pct", _percent(F.col("rideshare_trips"), whole))


def all_answers(
    summaries: dict[str, DataFrame],
    year: int = 2020,
    recovery: tuple[int, int, int] = (2019, 2020, 2021),
    quarter: int = 3,
    pricing_month: int = 1,
    pricing_years: tuple[int, int] = (2024, 2025),
) -> dict[str, DataFrame]:
    """Every answer table from stored summaries."""
    return {
        "answer_covid_monthly": month_by_month(summaries["monthly_trips"], year),
        "answer_borough_recovery": quarter_recovery(
            summaries["quarterly_recovery"], quarter, recovery
        ),
        "answer_rideshare_vs_yellow": fleet_share(summaries["yearly_summary"]),
        "answer_top_zones": top_zones(summaries["zone_summary"]),
        "answer_weather_impact": weather_impact(summaries["weather_summary"]),
        "answer_rush_hour": rush_hour(summaries["hourly_summary"]),
        "answer_payment_patterns": payment_patterns(summaries["payment_summary"]),
        "answer_borough_revenue": borough_revenue(summaries["borough_summary"]),
        "answer_congestion_pricing": same_month(
            summaries["monthly_trips"], pricing_month, pricing_years
        ),
        "answer_yearly_tips": yearly_tips(summaries["monthly_trips"]),
    }
