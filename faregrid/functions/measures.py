"""Sums and means that do not depend on the order of the rows.

A measure is added up as decimals in three limbs, every value by the digits its shortest
text shows:

- below ``LARGE`` with ``PLACES`` places, which is all of an ordinary value;
- what such a value has beyond those places, with 37 places (0.01 * 0.07 and 1e-19 have some);
- from ``LARGE`` on with 8 places, all a double of that size shows.

Limbs are exact, combine on the map side, can be merged again at a coarser grain, and give
the same result whatever the partitioning. Nothing is rounded before it is summed, but for
digits beyond the 37th place, where a double under 1e-20 has some.

Infinite values, and those of ``HUGE`` or more in size, which no limb holds, are counted by
sign: the sum of a group that has some is infinite, NaN if it has both signs. NaN is missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from faregrid.functions.cleaning import nan_to_null

ROWS = "rows__n"
PLACES = 18
EXACT = f"decimal(38,{PLACES})"
FINE = "decimal(38,37)"
COARSE = "decimal(38,8)"
LARGE = 1e9
HUGE = 1e29


@dataclass(frozen=True)
class Measure:
    """A numeric column; NaN counts as missing."""

    column: str

    @property
    def units(self) -> str:
        return f"{self.column}__sum"

    @property
    def seen(self) -> str:
        return f"{self.column}__seen"

    @property
    def fine(self) -> str:
        return f"{self.column}__fine"

    @property
    def coarse(self) -> str:
        return f"{self.column}__coarse"

    @property
    def endless(self) -> tuple[str, str]:
        return f"{self.column}__up", f"{self.column}__down"

    def limbs(self) -> dict[str, str]:
        return {self.units: EXACT, self.fine: FINE, self.coarse: COARSE}

    def tally_columns(self) -> list[Column]:
        value = nan_to_null(F.col(self.column).cast("double"))
        size = F.abs(value)
        ordinary = F.when(size < LARGE, value).cast(EXACT)
        # only digits beyond the places make the two differ
        beyond = F.when(
            (size < 1) & (ordinary.cast("double") != value),
            value.cast(FINE) - ordinary.cast(FINE),
        ).cast(FINE)
        large = F.when((size >= LARGE) & (size < HUGE), value).cast(COARSE)
        up, down = self.endless
        parts = {self.units: ordinary, self.fine: beyond, self.coarse: large}
        return [
            *[F.sum(part).cast(self.limbs()[name]).alias(name) for name, part in parts.items()],
            F.count(value).alias(self.seen),
            F.count_if(value >= HUGE).alias(up),
            F.count_if(value <= -HUGE).alias(down),
        ]

    def merge_columns(self) -> list[Column]:
        return [
            *[F.sum(name).cast(kind).alias(name) for name, kind in self.limbs().items()],
            *[F.sum(name).alias(name) for name in (self.seen, *self.endless)],
        ]


FARE = Measure("fare_amount")
TIP = Measure("tip_amount")
TOTAL = Measure("total_amount")
DISTANCE = Measure("trip_distance")


def trips() -> Column:
    return F.col(ROWS)


def exact_sum(measure: Measure) -> Column:
    """The limbs together as a double, NULL when there are no values."""
    zero = F.lit(0.0)
    ordinary, fine, coarse = (F.col(name).cast("double") for name in measure.limbs())
    finite = F.when(fine.isNull() & coarse.isNull(), ordinary).otherwise(
        F.coalesce(coarse, zero) + (F.coalesce(ordinary, zero) + F.coalesce(fine, zero))
    )
    up, down = (F.col(name) > 0 for name in measure.endless)
    return (
        F.when(up & down, F.lit(float("nan")))
        .when(up, F.lit(float("inf")))
        .when(down, F.lit(float("-inf")))
        .otherwise(finite)
    )


def exact_mean(measure: Measure) -> Column:
    """Mean of the non-missing values, NULL when there are none."""
    return F.try_divide(exact_sum(measure), F.col(measure.seen))


def mean(measure: Measure, digits: int = 2) -> Column:
    return F.round(exact_mean(measure), digits)


def total(measure: Measure, digits: int = 0) -> Column:
    return F.round(exact_sum(measure), digits)


def mean_ratio_percent(top: Measure, bottom: Measure, digits: int = 2) -> Column:
    """Ratio of the two means in percent, NULL when the lower mean is zero."""
    return F.round(F.try_divide(exact_mean(top), exact_mean(bottom)) * 100, digits)
