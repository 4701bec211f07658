"""Declarative row rules, the pass / dead-letter split and the quality report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_FAILS = "fail"
NULL_UNKNOWN = "unknown"


@dataclass(frozen=True)
class InRange:
    """Every listed column lies between the two bounds, both included."""

    flag: str
    columns: tuple[str, ...]
    low: float
    high: float

    def test(self) -> Column:
        return reduce(and_, [F.col(c).between(self.low, self.high) for c in self.columns])


@dataclass(frozen=True)
class Present:
    """The column has a value, later than ``after`` when that is given."""

    flag: str
    column: str
    after: str | None = None

    def test(self) -> Column:
        present = F.col(self.column).isNotNull()
        if self.after is None:
            return present
        return present & (F.col(self.column) > F.lit(self.after).cast("timestamp_ntz"))


Rule = InRange | Present

# Accepted ranges of metered trips.
METERED_RULES: tuple[Rule, ...] = (
    InRange("valid_fare", ("fare_amount",), 0, 500),
    InRange("valid_distance", ("trip_distance",), 0, 100),
    InRange("valid_passengers", ("passenger_count",), 1, 6),
    Present("valid_pickup", "tpep_pickup_datetime"),
    Present("valid_dropoff", "tpep_dropoff_datetime"),
    InRange("valid_locations", ("PULocationID", "DOLocationID"), 1, 265),
    InRange("valid_total", ("total_amount",), 0, 1000),
)

# The same ranges under the column names of the stream payload.
STREAM_RULES: tuple[Rule, ...] = (
    InRange("valid_fare", ("fare_amount",), 0, 500),
    InRange("valid_distance", ("trip_distance",), 0, 100),
    InRange("valid_passengers", ("passenger_count",), 1, 6),
    Present("valid_pickup", "pickup_datetime"),
    Present("valid_dropoff", "dropoff_datetime"),
    InRange("valid_locations", ("pickup_location_id", "dropoff_location_id"), 1, 265),
    InRange("valid_total", ("total_amount",), 0, 1000),
)

# Accepted ranges of ride-hail trips.
RIDE_HAIL_RULES: tuple[Rule, ...] = (
    InRange("valid_fare", ("base_passenger_fare",), 0, 500),
    InRange("valid_miles", ("trip_miles",), 0, 200),
    InRange("valid_time", ("trip_time",), 0, 14400),
    Present("valid_pickup", "pickup_datetime"),
    Present("valid_dropoff", "dropoff_datetime", after="1971-01-01"),
    InRange("valid_locations", ("PULocationID", "DOLocationID"), 1, 265),
    InRange("valid_driver_pay", ("driver_pay",), 0, 500),
)


def flag_column(rule: Rule, null_policy: str) -> Column:
    if null_policy == NULL_FAILS:
        return F.coalesce(rule.test(), F.lit(False))
    return rule.test()


def verdict(rules: Sequence[Rule], null_policy: str) -> Column:
    """All rules at once; under ``unknown`` a NULL input can leave it NULL."""
    return reduce(and_, [flag_column(rule, null_policy) for rule in rules])


def with_flags(df: DataFrame, rules: Sequence[Rule], null_policy: str = NULL_FAILS) -> DataFrame:
    """Add one flag per rule and the overall ``is_valid``."""
    flags = {rule.flag: flag_column(rule, null_policy) for rule in rules}
    return df.withColumns(flags | {"is_valid": verdict(rules, null_policy)})


def passed(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that satisfy every rule.

    A filter drops NULL verdicts anyway, so the bare tests are used: they are
    simple comparisons that reach the Parquet scan as pushed filters.
    """
    return df.filter(reduce(and_, [rule.test() for rule in rules]))


def failed(
    df: DataFrame,
    rules: Sequence[Rule],
    null_policy: str = NULL_FAILS,
    stamp: str | None = None,
) -> DataFrame:
    """The dead-letter branch: rows that fail, with the flags that say why.

    ``fail`` sends rows with missing inputs here, so passed + failed = all rows;
    ``unknown`` leaves them out of both branches.
    """
    rejected = with_flags(df, rules, null_policy).filter(~F.col("is_valid"))
    return rejected.withColumn(stamp, F.current_timestamp()) if stamp else rejected


def report(df: DataFrame, rules: Sequence[Rule], null_policy: str = NULL_FAILS) -> DataFrame:
    """Totals, pass rate and failures per rule from a single pass over the rows."""
    valid = verdict(rules, null_policy)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(valid).alias("passed_rows"),
        F.count_if(~valid).alias("failed_rows"),
        *[
            F.count_if(~flag_column(rule, null_policy)).alias(f"failed_{rule.flag}")
            for rule in rules
        ],
    )
    return counts.withColumns(
        {
            "undecided_rows": F.col("total_rows") - F.col("passed_rows") - F.col("failed_rows"),
            "pass_rate_pct": F.round(
                F.try_divide(F.col("passed_rows") * 100.0, F.col("total_rows")), 1
            ),
        }
    )


# Declarative checks of finished tables -------------------------------------------------


@dataclass(frozen=True)
class NotNull:
    column: str
    check = "not_null"


@dataclass(frozen=True)
class Unique:
    column: str
    check = "unique"


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple
    check = "accepted_values"


Check = NotNull | Unique | AcceptedValues


def run_checks(tables: dict[str, tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """One row per check: table, column, check and the number of offending rows.

    Row-wise checks of a table share one aggregation pass; uniqueness counts the
    key values that occur more than once.
    """
    results = []
    for table, (df, checks) in tables.items():
        row_wise = [c for c in checks if not isinstance(c, Unique)]
        if row_wise:
            counted = df.agg(
                *[
                    F.count_if(
                        F.col(c.column).isNull()
                        if isinstance(c, NotNull)
                        else ~F.col(c.column).isin(*c.values)
                    ).alias(f"check_{i}")
                    for i, c in enumerate(row_wise)
                ]
            )
            cells = [
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.check).alias("check_name"),
                    F.col(f"check_{i}").alias("failing_rows"),
                )
                for i, c in enumerate(row_wise)
            ]
            results.append(counted.select(F.inline(F.array(*cells))))
        for c in checks:
            if isinstance(c, Unique):
                repeated = (
                    df.filter(F.col(c.column).isNotNull())
                    .groupBy(c.column)
                    .count()
                    .filter(F.col("count") > 1)
                )
                results.append(
                    repeated.agg(F.count(F.lit(1)).alias("failing_rows")).select(
                        F.lit(table).alias("table_name"),
                        F.lit(c.column).alias("column_name"),
                        F.lit(c.check).alias("check_name"),
                        "failing_rows",
                    )
                )
    return reduce(DataFrame.unionByName, results).withColumn(
        "passed", F.col("failing_rows") == 0
    )
