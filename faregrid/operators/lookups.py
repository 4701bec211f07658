"""Joins of trips to dimension and weather tables.

No join here carries a broadcast hint: the planner broadcasts a side when its
file statistics, or the size measured at run time, are below the threshold, and
otherwise shuffles with adaptive skew splitting. Rollups go further and shrink
the fact to one row per key before they join (see ``dimension_rollup``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregrid.functions.measures import Measure
from faregrid.functions.timeparts import date_text
from faregrid.operators.tally import merge, tally

WEATHER_KEYS = ["pickup_date_str", "pickup_hour"]
WEATHER_COLUMNS = {
    "weather_temp_c": "double",
    "weather_wind_kmh": "double",
    "weather_precip_mm": "double",
}
CONDITION_COLUMN = {"weather_condition": "string"}

# column of the typed hourly file -> column of the enriched trip
WEATHER_RENAMES = {
    "temperature": "weather_temp_c",
    "precipitation": "weather_precip_mm",
    "wind_speed": "weather_wind_kmh",
    "condition": "weather_condition",
}


def with_zone(trips: DataFrame, zones: DataFrame, role: str, prefix: str = "") -> DataFrame:
    """Inner join to the zone dimension in one role (``pickup`` or ``dropoff``)."""
    renamed = zones.select(
        F.col("location_id").alias(f"{role}_location_id"),
        *[F.col(c).alias(f"{prefix}{c}") for c in zones.columns if c != "location_id"],
    )
    return trips.join(renamed, f"{role}_location_id")


def with_calendar(trips: DataFrame, calendar: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner join to the calendar by ``date_key``; rows outside the calendar leave."""
    return trips.join(calendar.select("date_key", *columns), "date_key")


def with_weather(trips: DataFrame, hourly: DataFrame) -> DataFrame:
    """Left join on date text and hour; the hourly table has one row per key."""
    return trips.join(hourly, WEATHER_KEYS, "left")


def with_weather_file(trips: DataFrame, hourly: DataFrame | None) -> DataFrame:
    """Left join to the typed hourly file; without one the columns are typed NULLs."""
    if hourly is None:
        missing = {**WEATHER_COLUMNS, **CONDITION_COLUMN}
        return trips.withColumns(
            {"hour": F.lit(None).cast("int")}
            | {name: F.lit(None).cast(kind) for name, kind in missing.items()}
        )
    keyed = trips.withColumn("pickup_date_str", date_text(F.col("pickup_datetime")))
    same_hour = (keyed["pickup_date_str"] == hourly["date"]) & (
        keyed["pickup_hour"] == hourly["hour"]
    )
    joined = keyed.join(hourly, same_hour, "left").drop("date", "pickup_date_str")
    return joined.withColumnsRenamed(WEATHER_RENAMES)


def match_rate(enriched: DataFrame, column: str = "weather_temp_c") -> DataFrame:
    """Rows, matched rows and the matched share in percent, in one pass."""
    return enriched.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(column).alias("matched"),
    ).select(
        "rows",
        "matched",
        F.round(F.try_divide(F.col("matched") * 100.0, F.col("rows")), 1).alias("match_pct"),
    )


def row_count_guard(before: DataFrame, after: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Evidence that a left join kept the row count: counts and repeated right keys."""
    repeated = right.groupBy(*keys).count().filter("count > 1")
    parts = {"rows_before": before, "rows_after": after, "repeated_keys": repeated}
    counts = [
        df.agg(
            *[(F.count(F.lit(1)) if name == part else F.lit(0).cast("bigint")).alias(name)
              for name in parts]
        )
        for part, df in parts.items()
    ]
    total = reduce(DataFrame.unionByName, counts).agg(*[F.sum(n).alias(n) for n in parts])
    return total.withColumn("unchanged", F.col("rows_before") == F.col("rows_after"))


def dimension_rollup(
    fact: DataFrame,
    zones: DataFrame,
    fact_keys: Sequence[str],
    zone_keys: Sequence[str],
    measures: Sequence[Measure],
    tallied: bool = False,
) -> DataFrame:
    """Tally the fact per zone first, then join the zone and merge.

    The join sees one row per (fact keys, zone) instead of one per trip, so a
    zone that holds a third of all trips costs no more than any other.
    """
    fine = [*fact_keys, "pickup_location_id"]
    cells = fact if tallied else tally(fact, fine, measures)
    located = with_zone(cells, zones.select("location_id", *zone_keys), "pickup")
    return merge(located, [*fact_keys, *zone_keys], measures)
