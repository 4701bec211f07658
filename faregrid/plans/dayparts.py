"""Questions by day that read only the partitions of the fact that hold those days.

The fact is stored by year and month of its drop, and a drop also holds trips of other
months, so the year and month of a day do not tell where its trips lie. A small table of
day parts does: each day of the calendar with each partition that has trips of it. A filter on
that table reaches the scan of the fact as dynamic partition pruning, and no trip is lost.

Trips of a partition whose year or month is missing are joined by their day alone. Days
without trips and trips outside the calendar have no row, as in any inner join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.functions.measures import Measure
from faregrid.operators.lookups import with_calendar
from faregrid.operators.tally import merge, tally
from faregrid.plans.jobs import FACT_PARTITIONS, Lake

PART = {name: f"part_{name}" for name in FACT_PARTITIONS}


def day_parts(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar rows with ``part_year`` and ``part_month``, once for each partition of their trips.

    Only the day and the partition columns of the fact are read; days shrink before the
    shuffle to one row per task and partition.
    """
    known = fact.dropna(subset=list(FACT_PARTITIONS))
    held = known.select("date_key", *[F.col(c).alias(p) for c, p in PART.items()]).distinct()
    return held.join(calendar, "date_key")


def day_parts_job(spark: SparkSession, lake: Lake, fact: str) -> int:
    """Store the day parts of a gold fact beside it; run again whenever the fact was written."""
    parts = day_parts(lake.read(spark, f"gold/{fact}"), lake.read(spark, "gold/dim_time"))
    return lake.write(parts, f"gold/{fact}_days")


def tally_of_days(
    fact: DataFrame,
    parts: DataFrame,
    days: Column,
    attributes: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """Tally of the trips on the calendar days that meet ``days``, per calendar attribute.

    ``days`` and ``attributes`` are about columns of the calendar; ``parts`` is the stored
    table of ``fact``. The fact is tallied per partition and day before the join.
    """
    where = list(FACT_PARTITIONS)
    chosen = parts.filter(days).select(
        "date_key", *[F.col(p).alias(f"__{c}") for c, p in PART.items()], *attributes
    )
    cells = tally(fact.dropna(subset=where), [*where, "date_key"], measures)
    same = cells["date_key"] == chosen["date_key"]
    for c in where:
        same &= cells[c] == chosen[f"__{c}"]
    placed = cells.join(chosen, same).select(*_tallied(cells, where), *attributes)
    return merge(placed, attributes, measures)


def tally_of_unplaced_days(
    fact: DataFrame,
    calendar: DataFrame,
    days: Column,
    attributes: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """The same for trips in partitions without a year or month, which have no day parts."""
    missing = reduce(or_, [F.col(c).isNull() for c in FACT_PARTITIONS])
    cells = tally(fact.filter(missing), ["date_key"], measures)
    located = with_calendar(cells, calendar.filter(days), attributes)
    return merge(located, attributes, measures)


def trips_of_days(
    fact: DataFrame,
    parts: DataFrame,
    calendar: DataFrame,
    days: Column,
    attributes: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """Tally of all trips on the days that meet ``days``, per calendar attribute."""
    both = tally_of_days(fact, parts, days, attributes, measures).unionByName(
        tally_of_unplaced_days(fact, calendar, days, attributes, measures)
    )
    return merge(both, attributes, measures)


def _tallied(cells: DataFrame, where: Sequence[str]) -> list[Column]:
    return [cells[c] for c in cells.columns if c not in (*where, "date_key")]
