"""Named tables: registration as views, profiles, sinks and read-only SQL."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.operators.textaudit import FULL_GUARD, MAX_LIMIT, GuardProfile, audit
from faregrid.sources.readers import lake_table

# The tables that serve answers.
SERVING_TABLES = (
    "monthly_trips",
    "borough_summary",
    "zone_summary",
    "hourly_summary",
    "weather_summary",
    "quarterly_recovery",
    "yearly_summary",
    "payment_summary",
    "answer_covid_monthly",
    "answer_borough_recovery",
    "answer_rideshare_vs_yellow",
    "answer_top_zones",
    "answer_weather_impact",
    "answer_rush_hour",
    "answer_payment_patterns",
    "answer_borough_revenue",
    "answer_congestion_pricing",
    "answer_yearly_tips",
)
GOLD_TABLES = ("fact_trips_yellow", "fact_trips_fhvhv", "dim_time", "dim_zone")


def register(tables: Mapping[str, DataFrame]) -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def register_folder(
    spark: SparkSession, root: str, names: Iterable[str], fmt: str = "parquet"
) -> tuple[list[str], list[str]]:
    """Register the stored tables below ``root``; missing ones are skipped and named."""
    found, skipped = [], []
    for name in names:
        try:
            lake_table(spark, f"{root}/{name}", fmt).createOrReplaceTempView(name)
            found.append(name)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            skipped.append(name)
    return found, skipped


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table as one distributed query."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def limited(df: DataFrame, rows: int | None = None, most: int = MAX_LIMIT) -> DataFrame:
    """All rows, or the number asked for; asking for more than ``most`` is an error."""
    if rows is None:
        return df
    if not 0 <= rows <= most:
        raise ValueError(f"{rows} rows asked for, at most {most} are listed")
    return df.limit(rows)


def sample_rows(df: DataFrame, key: str, share: float) -> DataFrame:
    """The rows whose key falls into ``share`` of all hashes; the same rows every time."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return df.filter(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < share * 2**32)


def route_result(spark: SparkSession, table: str, rows: int | None = None) -> DataFrame:
    """What a routed question returns: the rows of its table."""
    return limited(spark.table(table), rows)


def route_counts(routed: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Questions per target table, with the rows each of them gets."""
    asked = routed.groupBy("target_table").agg(F.count(F.lit(1)).alias("questions"))
    return asked.join(
        profile(tables).withColumnRenamed("table_name", "target_table"), "target_table", "left"
    )


def _foreign(plan, known: set[str]) -> list[str]:
    """Leaves of an analysed plan, with its subqueries, that are not below a known view."""
    kind = plan.getClass().getSimpleName()
    if kind == "View":
        name = plan.desc().identifier().table()
        return [] if name.lower() in known else [name]
    found: list[str] = []
    for below in (plan.children(), plan.subqueries(), plan.innerChildren()):
        for i in range(below.length()):
            item = below.apply(i)
            if hasattr(item, "subqueries"):
                found += _foreign(item, known)
    if not plan.children().length() and kind not in (
        "OneRowRelation", "LocalRelation", "CTERelationRef", "UnresolvedInlineTable"
    ):
        found.append(kind)
    return found


# functions that reach outside the tables
OUTSIDE_CALLS = r"(?i)\b(?:try_)?(?:reflect|java_method|read_files)\s*\("


def read_only_sql(
    spark: SparkSession,
    text: str,
    profile: GuardProfile = FULL_GUARD,
    rows: int | None = None,
) -> DataFrame:
    """Run one guarded SELECT over the registered views.

    The text goes through the same audit as a table of texts. Since a text can name a
    table in ways the audit does not see, the analysed plan is then checked: all it
    reads must be views of the profile, or registered views if it lists none. Nothing
    runs before both hold; otherwise ``ValueError`` names the reason. ``rows`` limits the
    result; without it, every row the text asks for is returned.
    """
    verdict = audit(spark.createDataFrame([(text,)], "query_text string"), "query_text", profile)
    checked = verdict.first()
    if not checked["valid"]:
        raise ValueError(checked["error"])
    if re.search(OUTSIDE_CALLS, checked["sanitised"]):
        raise ValueError("Function not allowed")
    listed = profile.tables or [
        t.name for t in spark.catalog.listTables() if t.isTemporary
    ]
    result = spark.sql(checked["sanitised"])
    foreign = _foreign(result._jdf.queryExecution().analyzed(), {t.lower() for t in listed})
    if foreign:
        raise ValueError(f"Relations not allowed: {', '.join(sorted(set(foreign)))}")
    return limited(result, rows)
