"""Gold tables: facts, calendar, zones and the small star over stream silver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.functions import labels, timeparts, tripmath
from faregrid.functions.measures import Measure, exact_mean
from faregrid.operators.dedup import distinct_columns
from faregrid.operators.quality import AcceptedValues, Check, NotNull, Unique, run_checks
from faregrid.operators.tally import present, tally

METERED_TAG = "yellow"
RIDE_HAIL_TAG = "fhvhv"

# Fact columns that keep their silver name or are renamed.
METERED_FACT = {
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "pickup_hour": "pickup_hour",
    "year": "puYear",
    "month": "puMonth",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "total_amount": "total_amount",
    "passenger_count": "passenger_count",
    "payment_type": "payment_type",
    "rate_code": "RatecodeID",
    "is_weekend": "is_weekend",
    "is_rush_hour": "is_rush_hour",
    "weather_temp_c": "weather_temp_c",
    "weather_wind_kmh": "weather_wind_kmh",
    "weather_precip_mm": "weather_precip_mm",
}
RIDE_HAIL_FACT = {
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "pickup_hour": "pickup_hour",
    "year": "puYear",
    "month": "puMonth",
    "trip_distance": "trip_miles",
    "fare_amount": "base_passenger_fare",
    "tip_amount": "tips",
    "driver_pay": "driver_pay",
    "trip_time": "trip_time",
    "company": "company",
    "hvfhs_license_num": "hvfhs_license_num",
    "shared_request_flag": "shared_request_flag",
    "shared_match_flag": "shared_match_flag",
    "wav_request_flag": "wav_request_flag",
    "is_weekend": "is_weekend",
    "is_rush_hour": "is_rush_hour",
}

# The contract between stream silver and the star.
STAGING_COLUMNS = (
    "vendor_id",
    "pickup_datetime", "dropoff_datetime",
    "pickup_hour", "pickup_month", "pickup_year", "pickup_dow", "is_weekend", "is_rush_hour",
    "pickup_location_id", "dropoff_location_id",
    "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount",
    "payment_type",
    "weather_temp_c", "weather_precip_mm", "weather_wind_kmh", "weather_condition",
    "kafka_partition", "kafka_offset", "ingestion_timestamp", "silver_timestamp",
)
# What the finished star must satisfy.
STAR_CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_silver_trips": (
        NotNull("pickup_datetime"),
        NotNull("fare_amount"),
        NotNull("pickup_location_id"),
    ),
    "fact_trips": (
        NotNull("fare_amount"),
        NotNull("pickup_location_id"),
        NotNull("pickup_datetime"),
    ),
    "dim_zone": (NotNull("zone_id"), Unique("zone_id")),
    "dim_time": (NotNull("pickup_hour"),),
    "dim_weather": (
        NotNull("weather_condition"),
        AcceptedValues("weather_condition", ("Clear", "Rain", "Snow")),
    ),
}
CLOCK_COLUMNS = (
    "pickup_hour", "pickup_month", "pickup_year", "pickup_dow", "is_weekend", "is_rush_hour",
)


def _project(silver: DataFrame, pickup: str, columns: Mapping[str, str], tag: str) -> DataFrame:
    return silver.select(
        timeparts.date_key(F.col(pickup)).alias("date_key"),
        *[F.col(source).alias(name) for name, source in columns.items()],
        F.lit(tag).alias("taxi_type"),
    )


def metered_fact(enriched: DataFrame) -> DataFrame:
    return _project(enriched, "tpep_pickup_datetime", METERED_FACT, METERED_TAG)


def ride_hail_fact(silver: DataFrame) -> DataFrame:
    return _project(silver, "pickup_datetime", RIDE_HAIL_FACT, RIDE_HAIL_TAG)


def both_facts(metered: DataFrame, ride_hail: DataFrame) -> DataFrame:
    """All trips under one schema; columns only one fleet has are NULL for the other."""
    return metered.unionByName(ride_hail, allowMissingColumns=True)


def calendar(days: DataFrame) -> DataFrame:
    """Attributes of each calendar day."""
    day = F.col("date")
    return days.select(
        timeparts.date_key(day).alias("date_key"),
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(*timeparts.WEEKEND_DAYS).alias("is_weekend"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )


def zones_with_ordinal(
    zones: DataFrame,
    ordinals: Mapping[str, int] = labels.BOROUGH_ORDINALS,
    other: int = labels.OTHER_BOROUGH,
) -> DataFrame:
    return zones.withColumn("borough_id", labels.borough_ordinal(F.col("borough"), ordinals, other))


def staging(silver: DataFrame) -> DataFrame:
    return silver.select(*STAGING_COLUMNS)


def admitted() -> Column:
    """Trips the star admits: both times known and a positive fare."""
    return (
        F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (F.col("fare_amount") > 0)
    )


def star_fact(staged: DataFrame) -> DataFrame:
    """One row per admitted trip with its derived measures."""
    return staged.filter(admitted()).select(
        "fare_amount",
        "tip_amount",
        "total_amount",
        "trip_distance",
        "passenger_count",
        "payment_type",
        tripmath.duration_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias(
            "trip_duration_minutes"
        ),
        tripmath.fare_per_mile(F.col("fare_amount"), F.col("trip_distance")).alias("fare_per_mile"),
        tripmath.tip_percent(F.col("tip_amount"), F.col("fare_amount")).alias("tip_pct"),
        "pickup_location_id",
        "dropoff_location_id",
        *CLOCK_COLUMNS,
        "weather_condition",
        "weather_temp_c",
        "weather_precip_mm",
        "weather_wind_kmh",
        "pickup_datetime",
        "dropoff_datetime",
        "vendor_id",
        "kafka_offset",
        "ingestion_timestamp",
        "silver_timestamp",
    )


def star_clock(staged: DataFrame) -> DataFrame:
    """Hours that occur in the trips, named by month and part of the day."""
    seen = distinct_columns(staged.filter(F.col("pickup_datetime").isNotNull()), CLOCK_COLUMNS)
    return seen.withColumns(
        {
            "month_name": timeparts.month_name(F.col("pickup_month")),
            "time_of_day": timeparts.part_of_day(F.col("pickup_hour")),
        }
    )


def star_weather(staged: DataFrame) -> DataFrame:
    """Mean of the distinct readings of each condition (not weighted by trips).

    The sums are exact, whatever the order of the rows.
    """
    readings = ("weather_temp_c", "weather_precip_mm", "weather_wind_kmh")
    seen = distinct_columns(
        staged.filter(F.col("weather_condition").isNotNull()), ["weather_condition", *readings]
    )

    temperature, rain, wind = (
        Measure(c) for c in ("weather_temp_c", "weather_precip_mm", "weather_wind_kmh")
    )
    means = present(
        tally(seen, ["weather_condition"], [temperature, rain, wind]),
        ["weather_condition"],
        {
            "avg_temp_c": exact_mean(temperature),
            "avg_precip_mm": exact_mean(rain),
            "avg_wind_kmh": exact_mean(wind),
        },
    )
    return means.withColumn("demand_impact", labels.demand_text(F.col("weather_condition")))


def star_zones(zones: DataFrame) -> DataFrame:
    """Zone dimension under the column names of the star, with the borough ordinal."""
    named = zones.select(
        F.col("location_id").alias("zone_id"), F.col("zone").alias("zone_name"), "borough"
    )
    return zones_with_ordinal(named)


def star_tables(staged: DataFrame, zones: DataFrame) -> dict[str, DataFrame]:
    return {
        "fact_trips": star_fact(staged),
        "dim_zone": star_zones(zones),
        "dim_time": star_clock(staged),
        "dim_weather": star_weather(staged),
    }


def check_star(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Result of every declared check of the given tables."""
    return run_checks({name: (tables[name], STAR_CHECKS[name]) for name in tables})


def fact_counts(metered: DataFrame, ride_hail: DataFrame) -> DataFrame:
    """Rows per fact and of both together."""
    counts = metered.agg(
        F.count(F.lit(1)).alias("metered_rows"), F.lit(0).cast("bigint").alias("ride_hail_rows")
    ).unionByName(
        ride_hail.agg(
            F.lit(0).cast("bigint").alias("metered_rows"), F.count(F.lit(1)).alias("ride_hail_rows")
        )
    )
    return counts.agg(
        F.sum("metered_rows").alias("metered_rows"), F.sum("ride_hail_rows").alias("ride_hail_rows")
    ).withColumn("combined_rows", F.col("metered_rows") + F.col("ride_hail_rows"))
