"""Removal of repeated business keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The business keys of a trip.
METERED_KEYS = ["tpep_pickup_datetime", "PULocationID", "DOLocationID", "fare_amount"]
STREAM_KEYS = ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount"]
# The drop year is part of the key: repeats are removed within a year, in one job.
RIDE_HAIL_KEYS = [
    "pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "base_passenger_fare",
    "driver_pay",
    "puYear",
]


# Which of the repeats stays: the smallest by these, then by a hash of the whole row.
METERED_SURVIVOR = ["tip_amount", "total_amount", "tpep_dropoff_datetime"]
RIDE_HAIL_SURVIVOR = ["tips", "trip_miles", "dropoff_datetime"]


def first_per_key(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = (), complete: bool = False
) -> DataFrame:
    """Keep one row per key, NULL keys being equal, always the same one.

    The survivor is the smallest row by ``tie_break`` and then by a hash of all other
    columns. Only the keys, those columns, the hash and what is used later are sorted
    and shuffled, so a rollup of a few columns does not move whole rows. The ``== 1``
    filter lets Spark keep only the best row per key in every map task
    (``WindowGroupLimit``) before anything is shuffled, so a key repeated a billion
    times reaches the final task once per map task.

    ``complete`` says that ``tie_break`` names one row, as partition and offset name a
    message: no hash is taken then, and columns nobody uses later are not read.
    """
    others = [c for c in df.columns if c not in keys and c not in tie_break]
    hashed = [F.xxhash64(*others).alias("__row")] if others and not complete else []
    order = [*tie_break, *(["__row"] if hashed else [])] or [F.lit(0)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.select("*", *hashed).withColumn("__place", place).filter(F.col("__place") == 1)
    return ranked.drop("__place", "__row")


def removed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after removal; only distinct keys are shuffled, not rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
            F.count(F.lit(1)).alias("rows_after"),
        )
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )


def distinct_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
