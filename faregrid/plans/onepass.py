"""Silver in one pass: rules, duplicates, both outcomes and all counts from one scan and one write.

Every row gets its flags once. A failing row has a key of its own, so the removal of
duplicates passes it on, and no two rows of the dead letters are taken for each other. The
result is one table partitioned by outcome first: kept rows and dead letters are two
folders of it, committed together, and a reader of one does not touch the other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.operators import dedup, quality
from faregrid.operators.lookups import with_weather
from faregrid.plans import silver
from faregrid.plans.jobs import Lake
from faregrid.sources import sinks
from faregrid.sources.counted import Counted, believed

OUTCOME = "outcome"
KEPT, FAILED = "kept", "failed"
_OWN = "__own_key"


@dataclass(frozen=True)
class Fleet:
    """What the silver of one fleet is made of."""

    name: str
    rules: Sequence[quality.Rule]
    keys: Sequence[str]
    survivor: Sequence[str]
    features: Callable[[DataFrame], DataFrame]


METERED = Fleet(
    "metered",
    quality.METERED_RULES,
    dedup.METERED_KEYS,
    dedup.METERED_SURVIVOR,
    silver.metered_features,
)
RIDE_HAIL = Fleet(
    "ride_hail",
    quality.RIDE_HAIL_RULES,
    dedup.RIDE_HAIL_KEYS,
    dedup.RIDE_HAIL_SURVIVOR,
    silver.ride_hail_features,
)


def report_counts(rules: Sequence[quality.Rule]) -> dict[str, Column]:
    """The counts of ``quality.report``, over rows with flags."""
    return {
        "total_rows": F.count(F.lit(1)),
        "passed_rows": F.count_if("is_valid"),
        "failed_rows": F.count_if(~F.col("is_valid")),
    } | {f"failed_{rule.flag}": F.count_if(~F.col(rule.flag)) for rule in rules}


def outcomes(flagged: DataFrame, fleet: Fleet) -> DataFrame:
    """Valid rows once per business key and all failing rows, told apart by ``outcome``.

    Rows without a verdict (``unknown`` policy) have no outcome and are left out.
    """
    own = F.when(~F.col("is_valid"), F.monotonically_increasing_id())
    judged = flagged.filter(F.col("is_valid").isNotNull()).withColumn(_OWN, own)
    single = dedup.first_per_key(judged, [*fleet.keys, _OWN], fleet.survivor).drop(_OWN)
    return single.withColumn(OUTCOME, F.when(F.col("is_valid"), KEPT).otherwise(FAILED))


def stored_outcomes(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, int]:
    """Rows of each outcome; only the folder names and footers are read."""
    rows = spark.read.format(fmt).load(path).groupBy(OUTCOME).count().collect()
    found = {r[OUTCOME]: r["count"] for r in rows}
    return {f"{name}_stored": found.get(name, 0) for name in (KEPT, FAILED)}


def branches(
    spark: SparkSession, path: str, rules: Sequence[quality.Rule], fmt: str = "parquet"
) -> silver.Silver:
    """Kept rows without flags, and dead letters with them, of the stored table."""
    both = spark.read.format(fmt).load(path)
    flags = [rule.flag for rule in rules] + ["is_valid"]
    return silver.Silver(
        kept=both.filter(F.col(OUTCOME) == KEPT).drop(OUTCOME, *flags),
        dead_letters=both.filter(F.col(OUTCOME) == FAILED).drop(OUTCOME),
    )


def split_job(
    spark: SparkSession, lake: Lake, fleet: Fleet, null_policy: str = quality.NULL_FAILS
) -> dict[str, int]:
    """Bronze to ``silver_split``; returns the quality report and the rows of both outcomes."""
    bronze = lake.read(spark, f"bronze/{fleet.name}")
    path = lake.path(f"silver_split/{fleet.name}")
    flagged = quality.with_flags(bronze, fleet.rules, null_policy)
    seen = Counted(flagged, "rules", report_counts(fleet.rules))
    partitions = (OUTCOME, *sinks.PARTITIONS)
    flags = [rule.flag for rule in fleet.rules] + ["is_valid"]
    # flags and features are taken again or made after the last shuffle, so none moves them
    raw = outcomes(seen.rows, fleet).drop(*flags)
    moved = sinks.clustered(raw, partitions)
    rows = quality.with_flags(moved, fleet.rules, null_policy)
    rows = fleet.features(rows.select(*flagged.columns, OUTCOME))
    if bronze.isEmpty():  # partitions of nothing would leave a folder without a schema
        sinks.replace_all(rows, path, fmt=lake.fmt)
        return dict.fromkeys(report_counts(fleet.rules), 0) | {"kept_stored": 0, "failed_stored": 0}
    sinks.replace_all(rows, path, partitions, lake.fmt, rebalance=False)
    stored = stored_outcomes(spark, path, lake.fmt)
    known = {"total_rows": bronze.count(), "failed_rows": stored["failed_stored"]}

    def recount() -> dict[str, int]:
        return flagged.agg(*[c.alias(n) for n, c in report_counts(fleet.rules).items()]).first().asDict()

    return believed(seen.values(), known, recount) | stored


def quality_report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The counts of ``split_job`` as the row of ``quality.report``, with removed duplicates."""
    kind = ", ".join(f"{name} bigint" for name in counts)
    return spark.createDataFrame([tuple(counts.values())], kind).withColumns(
        {
            "undecided_rows": F.col("total_rows") - F.col("passed_rows") - F.col("failed_rows"),
            "pass_rate_pct": F.round(
                F.try_divide(F.col("passed_rows") * 100.0, F.col("total_rows")), 1
            ),
            "removed_rows": F.col("passed_rows") - F.col("kept_stored"),
        }
    )


def enrich_job(spark: SparkSession, lake: Lake, split: str = "silver_split/metered") -> dict[str, int]:
    """Kept rows with the weather of their hour; rows and matched rows from the write itself.

    Raises if the join changed the number of rows.
    """
    trips = branches(spark, lake.path(split), METERED.rules, lake.fmt).kept
    joined = with_weather(trips, lake.read(spark, "silver/weather"))
    matched = {"rows": F.count(F.lit(1)), "matched": F.count("weather_temp_c")}
    seen = Counted(joined, "weather", matched)
    target = "silver/metered_enriched"
    stored = lake.write(seen.rows, target, sinks.PARTITIONS, rebalance=False)
    before = trips.count()
    if stored != before:
        raise ValueError(f"the weather join made {stored} rows of {before}")

    def recount() -> dict[str, int]:
        table = lake.read(spark, target)
        return table.agg(*[c.alias(n) for n, c in matched.items()]).first().asDict()

    return believed(seen.values(), {"rows": stored}, recount)
