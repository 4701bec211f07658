"""Decoding of raw station reports and their hourly summary.

A report field is a comma-separated code list: ``TMP`` carries tenths of a
degree first, ``WND`` tenths of m/s in its fourth part, ``AA1`` tenths of a
millimetre in its second part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.functions.cleaning import nan_to_null, sentinel_to_null, to_double
from faregrid.functions.labels import weather_condition
from faregrid.functions.measures import Measure, mean, total
from faregrid.functions.timeparts import date_text
from faregrid.operators.tally import present, tally

# Codes for "not measured", and the plausible ranges.
MISSING_TEMPERATURE = ("+9999", "-9999")
MISSING_CODE = "9999"
KMH_PER_MPS = 3.6
MAX_PLAUSIBLE_CELSIUS = 99
MAX_PLAUSIBLE_KMH = 300

TEMPERATURE = Measure("weather_temp_c")
WIND = Measure("weather_wind_kmh")
RAIN = Measure("weather_precip_mm")


def part(field: str, index: int) -> Column:
    """Part ``index`` of a code list, NULL when the list is shorter or absent."""
    return F.get(F.split(F.col(field), ","), F.lit(index))


def report_time() -> Column:
    return F.col("DATE").try_cast("timestamp_ntz")


def decode_reports(reports: DataFrame) -> DataFrame:
    """Default profile: sentinels become NULL, missing rain becomes 0."""
    temperature = sentinel_to_null(part("TMP", 0), *MISSING_TEMPERATURE)
    wind = sentinel_to_null(part("WND", 3), MISSING_CODE)
    rain = sentinel_to_null(part("AA1", 1), MISSING_CODE)
    moment = report_time()
    return reports.filter(moment.isNotNull()).select(
        F.col("DATE").alias("weather_datetime"),
        date_text(moment).alias("pickup_date_str"),
        F.hour(moment).alias("pickup_hour"),
        (to_double(temperature) / 10).alias("weather_temp_c"),
        F.round(to_double(wind) / 10 * KMH_PER_MPS, 1).alias("weather_wind_kmh"),
        F.coalesce(to_double(rain) / 10, F.lit(0.0)).alias("weather_precip_mm"),
    )


def decode_reports_strict(reports: DataFrame) -> DataFrame:
    """Strict profile: whole-number codes only, implausible readings are dropped.

    Reports without a usable temperature leave; the condition of each report is
    derived from its own readings.
    """
    celsius = part("TMP", 0).try_cast("int") / F.lit(10.0)
    celsius = F.when(F.abs(celsius) <= MAX_PLAUSIBLE_CELSIUS, celsius)
    kmh = F.round(part("WND", 3).try_cast("int") / F.lit(10.0) * KMH_PER_MPS, 1)
    kmh = F.when(kmh <= MAX_PLAUSIBLE_KMH, kmh)
    rain = sentinel_to_null(part("AA1", 1), MISSING_CODE).try_cast("int") / F.lit(10.0)
    moment = report_time()
    return (
        reports.filter(moment.isNotNull())
        .select(
            date_text(moment).alias("date"),
            F.hour(moment).alias("hour"),
            celsius.alias("temperature"),
            F.coalesce(rain, F.lit(0.0)).alias("precipitation"),
            kmh.alias("wind_speed"),
        )
        .filter(F.col("temperature").isNotNull())
        .withColumn("condition", weather_condition(F.col("precipitation"), F.col("temperature")))
    )


def hourly_weather(decoded: DataFrame) -> DataFrame:
    """One row per date and hour: mean temperature, strongest wind, total rain."""
    return (
        decoded.groupBy("pickup_date_str", "pickup_hour")
        .agg(
            *TEMPERATURE.tally_columns(),
            *RAIN.tally_columns(),
            F.max(nan_to_null(F.col("weather_wind_kmh"))).alias("strongest"),
        )
        .select(
            "pickup_date_str",
            "pickup_hour",
            mean(TEMPERATURE, 1).alias("weather_temp_c"),
            F.round("strongest", 1).alias("weather_wind_kmh"),
            total(RAIN, 1).alias("weather_precip_mm"),
        )
    )


def hourly_weather_strict(decoded: DataFrame) -> DataFrame:
    """Strict profile: mean wind, rain to two places, condition of the whole hour."""
    temperature, rain, wind = (
        Measure("temperature"),
        Measure("precipitation"),
        Measure("wind_speed"),
    )
    hours = present(
        tally(decoded, ["date", "hour"], [temperature, rain, wind]),
        ["date", "hour"],
        {
            "temperature": mean(temperature, 1),
            "precipitation": total(rain, 2),
            "wind_speed": mean(wind, 1),
        },
    )
    return hours.withColumn(
        "condition", weather_condition(F.col("precipitation"), F.col("temperature"))
    )


def condition_counts(hourly: DataFrame, column: str = "condition") -> DataFrame:
    return hourly.groupBy(column).agg(F.count(F.lit(1)).alias("hours"))

