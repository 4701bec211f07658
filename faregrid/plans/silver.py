"""Silver tables: features, rules, split, duplicates, weather."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregrid.functions.labels import company
from faregrid.functions.timeparts import LAKE_RUSH, STREAM_RUSH, date_text, with_time_features
from faregrid.operators import dedup, quality
from faregrid.operators.envelope import decode_payload
from faregrid.operators.lookups import with_weather, with_weather_file


@dataclass(frozen=True)
class Silver:
    """The rows to keep and the rows set aside."""

    kept: DataFrame
    dead_letters: DataFrame


def metered_features(bronze: DataFrame) -> DataFrame:
    timed = with_time_features(bronze, "tpep_pickup_datetime", LAKE_RUSH)
    return timed.withColumn("pickup_date_str", date_text(F.col("tpep_pickup_datetime")))


def ride_hail_features(bronze: DataFrame) -> DataFrame:
    timed = with_time_features(bronze, "pickup_datetime", LAKE_RUSH)
    return timed.withColumns(
        {
            "pickup_date_str": date_text(F.col("pickup_datetime")),
            "company": company(F.col("hvfhs_license_num")),
        }
    )


def metered_silver(bronze: DataFrame, null_policy: str = quality.NULL_FAILS) -> Silver:
    """Rules and duplicate removal run on the raw columns; features follow.

    Deriving the features after the shuffle keeps the shuffled rows narrow.
    """
    rules = quality.METERED_RULES
    passed = quality.passed(bronze, rules)
    kept = dedup.first_per_key(passed, dedup.METERED_KEYS, dedup.METERED_SURVIVOR)
    return Silver(
        kept=metered_features(kept),
        dead_letters=quality.failed(metered_features(bronze), rules, null_policy),
    )


def ride_hail_silver(bronze: DataFrame, null_policy: str = quality.NULL_FAILS) -> Silver:
    rules = quality.RIDE_HAIL_RULES
    passed = quality.passed(bronze, rules)
    kept = dedup.first_per_key(passed, dedup.RIDE_HAIL_KEYS, dedup.RIDE_HAIL_SURVIVOR)
    return Silver(
        kept=ride_hail_features(kept),
        dead_letters=quality.failed(ride_hail_features(bronze), rules, null_policy),
    )


def enriched_metered(kept: DataFrame, hourly: DataFrame) -> DataFrame:
    return with_weather(kept, hourly)


def stream_features(decoded: DataFrame) -> DataFrame:
    return with_time_features(decoded, "pickup_datetime", STREAM_RUSH)


def stream_trips(envelope: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return stream_features(decode_payload(envelope, keep))


def stream_silver(envelope: DataFrame, hourly: DataFrame | None = None) -> Silver:
    """Silver of the message path; the survivor of a key is its earliest message."""
    return stream_branches(stream_trips(envelope), hourly)


def stream_branches(trips: DataFrame, hourly: DataFrame | None = None) -> Silver:
    """Both branches of typed messages; stored ones are decoded once for the two."""
    rules = quality.STREAM_RULES
    kept = dedup.first_per_key(
        quality.passed(trips, rules),
        dedup.STREAM_KEYS,
        tie_break=["kafka_partition", "kafka_offset"],
        complete=True,
    )
    return Silver(
        kept=with_weather_file(kept, hourly),
        dead_letters=quality.failed(trips, rules, stamp="failure_timestamp"),
    )
