"""Questions users ask of the gold tables, each as one plan over the facts.

All of them shrink the fact to one row per group of keys before they join a
dimension, and filter on columns the scan can prune by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.functions import labels
from faregrid.functions.measures import DISTANCE, FARE, ROWS, TIP, mean, trips
from faregrid.operators.lookups import dimension_rollup, with_calendar
from faregrid.operators.tally import merge, present, tally

METERED_NAME = "yellow"


def month_in_two_years(
    fact: DataFrame, zones: DataFrame, month: int, years: tuple[int, int]
) -> DataFrame:
    """Trips of one month in two years per borough, side by side."""
    chosen = fact.filter((F.col("month") == month) & F.col("year").isin(*years))
    rows = dimension_rollup(chosen, zones, ["year"], ["borough"], [])

    def of_year(year: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("year") == year, F.col(ROWS))), F.lit(0))

    first, second = (f"trips_{year}" for year in years)
    return (
        rows.groupBy("borough")
        .agg(of_year(years[0]).alias(first), of_year(years[1]).alias(second))
        .withColumn(
            "change_pct",
            F.round(
                F.try_divide((F.col(second) - F.col(first)) * 100.0, F.col(first)), 1
            ),
        )
    )


def recovery_month(
    fact: DataFrame, base: tuple[int, int], trough: tuple[int, int], share: float
) -> DataFrame:
    """First month from the trough on whose trips reach ``share`` of the base month."""

    def number(period: tuple[int, int]) -> int:
        return period[0] * 12 + period[1] - 1

    monthly = fact.groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"))
    numbered = monthly.withColumn("nr", F.col("year") * 12 + F.col("month") - 1)
    # one row per calendar month from here on, so the list has a dozen entries a year
    found = numbered.agg(
        F.max(F.when(F.col("nr") == number(base), F.col("trips"))).alias("base_trips"),
        F.max(F.when(F.col("nr") == number(trough), F.col("trips"))).alias("trough_trips"),
        F.collect_list(
            F.when(F.col("nr") >= number(trough), F.struct("nr", "trips"))
        ).alias("later"),
    )
    reached = F.filter(
        F.col("later"), lambda m: m["trips"] >= F.col("base_trips") * F.lit(share)
    )
    at = F.array_min(reached)["nr"]
    return found.select(
        "base_trips",
        "trough_trips",
        F.floor(at / 12).cast("int").alias("recovery_year"),
        (at % 12 + 1).cast("int").alias("recovery_month"),
        (at - number(trough)).cast("int").alias("months_taken"),
    )


def fleet_or_company(both: DataFrame) -> DataFrame:
    """Tagged union of the facts with the company, or the fleet where there is none."""
    return both.withColumn("operator", F.coalesce("company", "taxi_type"))


def operator_trips_by_year(both: DataFrame, operators: tuple[str, ...]) -> DataFrame:
    """Trips of chosen companies or fleets per year, one column each."""
    named = fleet_or_company(both).filter(F.col("operator").isin(*operators))
    return named.groupBy("year").agg(
        *[
            F.count_if(F.col("operator") == name).alias(f"{name.lower()}_trips")
            for name in operators
        ]
    )


def busiest_company(ride_hail: DataFrame, year: int) -> DataFrame:
    counts = (
        ride_hail.filter(F.col("year") == year)
        .groupBy("company")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    return counts.orderBy(F.desc("trips"), "company").limit(1)


def rainy_or_dry(fact: DataFrame) -> DataFrame:
    """Trips and mean fare by rain bucket, trip-weighted; unmatched trips by themselves."""
    bucketed = fact.withColumn(
        "rain_bucket", labels.rain_bucket(F.col("weather_precip_mm"), "No reading")
    )
    return present(
        tally(bucketed, ["rain_bucket"], [FARE]),
        ["rain_bucket"],
        {"trips": trips(), "avg_fare": mean(FARE)},
    )


def cold_or_warm(fact: DataFrame, zones: DataFrame, borough: str) -> DataFrame:
    """Mean fare by temperature bucket of the trips that start in one borough."""
    bucketed = fact.withColumn(
        "temp_bucket", labels.temperature_bucket(F.col("weather_temp_c"), "No reading")
    )
    rows = dimension_rollup(
        bucketed, zones.filter(F.col("borough") == borough), ["temp_bucket"], [], [FARE]
    )
    return present(rows, ["temp_bucket"], {"trips": trips(), "avg_fare": mean(FARE)})


def tips_by_wind(fact: DataFrame) -> DataFrame:
    bucketed = fact.withColumn("wind_bucket", labels.wind_bucket(F.col("weather_wind_kmh")))
    return present(
        tally(bucketed, ["wind_bucket"], [TIP]),
        ["wind_bucket"],
        {"trips": trips(), "avg_tip": mean(TIP)},
    )


def top_zones_of_borough(
    fact: DataFrame, zones: DataFrame, borough: str, k: int = 10
) -> DataFrame:
    rows = dimension_rollup(fact, zones.filter(F.col("borough") == borough), [], ["zone"], [])
    return (
        present(rows, ["zone"], {"trips": trips()}).orderBy(F.desc("trips"), "zone").limit(k)
    )


def distance_of_zones(fact: DataFrame, zones: DataFrame, names: tuple[str, ...]) -> DataFrame:
    rows = dimension_rollup(fact, zones.filter(F.col("zone").isin(*names)), [], ["zone"], [DISTANCE])
    return present(rows, ["zone"], {"trips": trips(), "avg_distance": mean(DISTANCE)})


def busiest_borough(fact: DataFrame, zones: DataFrame, year: int, month: int) -> DataFrame:
    chosen = fact.filter((F.col("year") == year) & (F.col("month") == month))
    rows = dimension_rollup(chosen, zones, [], ["borough"], [])
    ordered = present(rows, ["borough"], {"trips": trips()})
    return ordered.orderBy(F.desc("trips"), "borough").limit(1)


def weekend_hours(fact: DataFrame) -> DataFrame:
    counts = (
        fact.filter("is_weekend").groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("trips"))
    )
    return counts.orderBy(F.desc("trips"), "pickup_hour")


def trips_between_boroughs(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Both roles of the zone dimension: trips per pickup and dropoff borough."""
    cells = tally(fact, ["pickup_location_id", "dropoff_location_id"], [FARE])
    named = zones.select("location_id", "borough")
    pickup = named.select(
        F.col("location_id").alias("pickup_location_id"), F.col("borough").alias("pickup_borough")
    )
    dropoff = named.select(
        F.col("location_id").alias("dropoff_location_id"), F.col("borough").alias("dropoff_borough")
    )
    keys = ["pickup_borough", "dropoff_borough"]
    located = cells.join(pickup, "pickup_location_id").join(dropoff, "dropoff_location_id")
    return present(
        merge(located, keys, [FARE]), keys, {"trips": trips(), "avg_fare": mean(FARE)}
    )


def trips_by_calendar(fact: DataFrame, calendar: DataFrame, attribute: str) -> DataFrame:
    """Trips per calendar attribute; the fact is counted per day before the join."""
    days = tally(fact, ["date_key"], [FARE])
    located = with_calendar(days, calendar, [attribute])
    return present(
        merge(located, [attribute], [FARE]), [attribute], {"trips": trips(), "avg_fare": mean(FARE)}
    )
