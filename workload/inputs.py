"""Shared inputs of the registered queries, built from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.operators import weather
from faregrid.operators.envelope import raw_envelope
from faregrid.operators.lookups import with_weather
from faregrid.plans import gold, silver
from faregrid.session import staged
from workload import adapters

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def texts(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that results compare without a time zone."""
    return df.withColumns({c: F.date_format(c, TIME_TEXT) for c in columns})


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.hourly_weather(weather.decode_reports(adapters.station_reports(spark, sf_dir)))


def hourly_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = weather.decode_reports_strict(adapters.station_reports(spark, sf_dir))
    return weather.hourly_weather_strict(decoded)


def metered_fact(spark: SparkSession, sf_dir: str, with_hours: bool = False) -> DataFrame:
    """Metered fact; the weather join is left out where no weather column is used."""
    kept = silver.metered_silver(adapters.metered_bronze(spark, sf_dir)).kept
    if with_hours:
        return gold.metered_fact(with_weather(kept, staged(hourly(spark, sf_dir), "weather")))
    missing = F.lit(None).cast("double")
    return gold.metered_fact(
        kept.withColumns(
            {
                "weather_temp_c": missing,
                "weather_wind_kmh": missing,
                "weather_precip_mm": missing,
            }
        )
    )


def ride_hail_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.ride_hail_fact(
        silver.ride_hail_silver(adapters.ride_hail_bronze(spark, sf_dir)).kept
    )


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_envelope(adapters.messages(spark, sf_dir))


def stream_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = staged(hourly_strict(spark, sf_dir), "hourly-file")
    return gold.staging(silver.stream_silver(envelope(spark, sf_dir), hours).kept)
