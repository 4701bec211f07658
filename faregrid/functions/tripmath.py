"""Per-trip measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000.0


def duration_minutes(pickup: Column, dropoff: Column) -> Column:
    """Elapsed minutes, fractions of a second included, to two places."""
    return F.round(F.timestamp_diff("MICROSECOND", pickup, dropoff) / MICROS_PER_MINUTE, 2)


def fare_per_mile(fare: Column, distance: Column) -> Column:
    return F.round(F.when(distance > 0, fare / distance), 2)


def tip_percent(tip: Column, fare: Column) -> Column:
    """Row-level tip share: zero, not missing, when there is no positive fare."""
    return F.round(F.when(fare > 0, tip / fare * 100).otherwise(0.0), 2)
