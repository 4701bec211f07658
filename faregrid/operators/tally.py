"""Group-by building blocks: tally raw rows, merge tallies, present results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.functions.measures import ROWS, Measure


def tally(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Row counts and exact sums per key; hot keys shrink before the shuffle."""
    columns = [c for m in measures for c in m.tally_columns()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *columns)


def tally_sets(
    df: DataFrame, sets: Mapping[str, Sequence[str]], measures: Sequence[Measure], label: str
) -> DataFrame:
    """Several tallies from one scan, one per named key list (grouping sets).

    Columns that are not keys of a set are NULL in its rows; ``label`` holds the
    name of the set.
    """
    keys = list(dict.fromkeys(k for ks in sets.values() for k in ks))
    columns = [c for m in measures for c in m.tally_columns()]
    grouped = df.groupingSets(
        [[F.col(k) for k in ks] for ks in sets.values()], *[F.col(k) for k in keys]
    ).agg(F.grouping_id().alias("__gid"), F.count(F.lit(1)).alias(ROWS), *columns)
    named = None
    for name, ks in sets.items():
        gid = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in ks)
        test = F.col("__gid") == gid
        named = F.when(test, name) if named is None else named.when(test, name)
    return grouped.withColumn(label, named).drop("__gid")


def merge(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Combine tallies to a coarser grain; exact, since the sums add up."""
    columns = [c for m in measures for c in m.merge_columns()]
    return df.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), *columns)


def present(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    return df.select(*keys, *[column.alias(name) for name, column in columns.items()])
