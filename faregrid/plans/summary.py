"""Summary tables.

Each rollup accepts the raw fact. When all of them are wanted, ``summary_cells``
scans the fact once for the three key sets they need, and ``all_summaries``
merges every table from those few rows: counts and sums add up exactly, so
both ways give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.functions import labels
from faregrid.functions.measures import (
    DISTANCE,
    FARE,
    TIP,
    TOTAL,
    Measure,
    mean,
    mean_ratio_percent,
    total,
    trips,
)
from faregrid.operators.lookups import dimension_rollup
from faregrid.operators.tally import merge, present, tally, tally_sets

METERED_LABEL = "Yellow Taxi"

MEASURES = (FARE, TIP, TOTAL, DISTANCE)
RIDE_HAIL_MEASURES = (FARE, TIP, DISTANCE)

# Key sets that together feed every metered summary.
CELL_SETS = {
    "clock": ["year", "month", "pickup_hour", "is_weekend", "is_rush_hour", "payment_type"],
    "place": ["year", "month", "pickup_location_id"],
    "weather": ["pickup_location_id", "temp_bucket", "rain_bucket"],
}
CELL_SET = "cell_set"


def _averages() -> dict[str, Column]:
    return {
        "trips": trips(),
        "avg_fare": mean(FARE),
        "avg_tip": mean(TIP),
        "avg_distance": mean(DISTANCE),
    }


def _revenue(measure: Measure = TOTAL) -> dict[str, Column]:
    return {"total_revenue": total(measure, 0)}


def with_buckets(fact: DataFrame, unmatched: str | None = None) -> DataFrame:
    return fact.withColumns(
        {
            "temp_bucket": labels.temperature_bucket(F.col("weather_temp_c"), unmatched),
            "rain_bucket": labels.rain_bucket(F.col("weather_precip_mm"), unmatched),
        }
    )


def summary_cells(fact: DataFrame) -> DataFrame:
    """All tallies the metered summaries need, from one scan of the fact."""
    return tally_sets(with_buckets(fact), CELL_SETS, MEASURES, CELL_SET)


def cells_of(cells: DataFrame, name: str) -> DataFrame:
    return cells.filter(F.col(CELL_SET) == name)


def _grouped(source: DataFrame, keys: list[str], tallied: bool, measures=MEASURES) -> DataFrame:
    return merge(source, keys, measures) if tallied else tally(source, keys, measures)


def monthly_metered(fact: DataFrame, tallied: bool = False) -> DataFrame:
    keys = ["year", "month"]
    rows = _grouped(fact, keys, tallied)
    return present(rows, keys, _averages() | _revenue() | {"taxi_type": F.lit(METERED_LABEL)})


def monthly_ride_hail(fact: DataFrame, tallied: bool = False) -> DataFrame:
    """Ride-hail revenue is the fare: the fleet reports no total."""
    rows = _grouped(fact, ["year", "month", "company"], tallied, RIDE_HAIL_MEASURES)
    columns = _averages() | _revenue(FARE) | {"taxi_type": F.col("company")}
    return present(rows, ["year", "month"], columns)


def monthly_trips(metered: DataFrame, ride_hail: DataFrame, tallied: bool = False) -> DataFrame:
    return monthly_metered(metered, tallied).unionByName(
        monthly_ride_hail(ride_hail, tallied), allowMissingColumns=True
    )


def yearly_summary(metered: DataFrame, ride_hail: DataFrame, tallied: bool = False) -> DataFrame:
    """Per year and fleet or company, weighted by trips."""
    first = present(
        _grouped(metered, ["year"], tallied),
        ["year"],
        _averages() | _revenue() | {"taxi_type": F.lit(METERED_LABEL)},
    )
    second = present(
        _grouped(ride_hail, ["year", "company"], tallied, RIDE_HAIL_MEASURES),
        ["year"],
        _averages() | _revenue(FARE) | {"taxi_type": F.col("company")},
    )
    return first.unionByName(second)


def borough_summary(fact: DataFrame, zones: DataFrame, tallied: bool = False) -> DataFrame:
    rows = dimension_rollup(fact, zones, ["year"], ["borough"], MEASURES, tallied)
    return present(
        rows,
        ["year", "borough"],
        _averages() | _revenue() | {"taxi_type": F.lit(METERED_LABEL)},
    )


def zone_totals(fact: DataFrame, zones: DataFrame, tallied: bool = False) -> DataFrame:
    keys = ["zone", "borough", "service_zone"]
    rows = dimension_rollup(fact, zones, [], keys, MEASURES, tallied)
    return present(rows, keys, _averages() | _revenue())


def zone_summary(fact: DataFrame, zones: DataFrame, tallied: bool = False) -> DataFrame:
    return zone_totals(fact, zones, tallied).orderBy(F.desc("trips"))


def hourly_summary(fact: DataFrame, tallied: bool = False) -> DataFrame:
    """Tip share is the ratio of the two means, NULL for a zero mean fare."""
    keys = ["pickup_hour", "is_weekend", "is_rush_hour"]
    columns = _averages() | {"avg_tip_pct": mean_ratio_percent(TIP, FARE)}
    return present(_grouped(fact, keys, tallied), keys, columns)


def payment_summary(fact: DataFrame, tallied: bool = False) -> DataFrame:
    keys = ["year", "payment_type"]
    columns = _averages() | {
        "avg_tip_pct": mean_ratio_percent(TIP, FARE),
        "payment_label": labels.payment_label(F.col("payment_type")),
    }
    return present(_grouped(fact, keys, tallied), keys, columns)


def weather_summary(
    fact: DataFrame, zones: DataFrame, tallied: bool = False, unmatched: str | None = None
) -> DataFrame:
    """Per borough and weather bucket; trips without weather sit in the open top
    buckets unless ``unmatched`` names a bucket of their own."""
    buckets = ["temp_bucket", "rain_bucket"]
    source = fact if tallied else with_buckets(fact, unmatched)
    rows = dimension_rollup(source, zones, buckets, ["borough"], MEASURES, tallied)
    return present(rows, ["borough", *buckets], _averages()).filter(
        F.col("temp_bucket").isNotNull()
    )


def quarterly_recovery(fact: DataFrame, zones: DataFrame, tallied: bool = False) -> DataFrame:
    cells = fact if tallied else tally(fact, ["year", "month", "pickup_location_id"], MEASURES)
    quartered = cells.withColumn("quarter", F.ceil(F.col("month") / F.lit(3)).cast("int"))
    rows = dimension_rollup(quartered, zones, ["year", "quarter"], ["borough"], MEASURES, True)
    return present(
        rows,
        ["year", "quarter", "borough"],
        {"trips": trips(), "avg_fare": mean(FARE)} | _revenue(),
    )


def all_summaries(
    cells: DataFrame, ride_hail_cells: DataFrame, zones: DataFrame
) -> dict[str, DataFrame]:
    """Every summary table from stored cells."""
    clock, place, weather = (cells_of(cells, name) for name in ("clock", "place", "weather"))
    return {
        "monthly_trips": monthly_trips(clock, ride_hail_cells, tallied=True),
        "yearly_summary": yearly_summary(clock, ride_hail_cells, tallied=True),
        "hourly_summary": hourly_summary(clock, tallied=True),
        "payment_summary": payment_summary(clock, tallied=True),
        "borough_summary": borough_summary(place, zones, tallied=True),
        "zone_summary": zone_summary(place, zones, tallied=True),
        "quarterly_recovery": quarterly_recovery(place, zones, tallied=True),
        "weather_summary": weather_summary(weather, zones, tallied=True),
    }


def ride_hail_cells(fact: DataFrame) -> DataFrame:
    return tally(fact, ["year", "month", "company"], RIDE_HAIL_MEASURES)
