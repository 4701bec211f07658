"""Null-safe conversions that never raise on dirty input (Spark 4 is ANSI)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    """NaN sorts above every number and poisons sums, so it is treated as missing."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def to_double(text: Column) -> Column:
    return nan_to_null(text.try_cast("double"))


def sentinel_to_null(value: Column, *codes) -> Column:
    return F.when(~value.isin(*codes), value)


def coded(value: Column, labels: Mapping, default) -> Column:
    """Translate ``value`` through a small fixed code table."""
    codes = list(labels.items())
    out = F.when(value == F.lit(codes[0][0]), F.lit(codes[0][1]))
    for code, label in codes[1:]:
        out = out.when(value == F.lit(code), F.lit(label))
    return out.otherwise(F.lit(default))

