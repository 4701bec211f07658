"""The lake jobs: each reads stored tables of one layer and writes the next.

Order: weather before silver enrichment, silver before gold, gold before
summaries, summaries before answers. Every job replaces what it writes, so any
of them can be repeated after a failure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from faregrid.operators import weather
from faregrid.plans import answers, gold, silver, summary
from faregrid.sources import catalogue, readers, sinks


@dataclass(frozen=True)
class Lake:
    """Where the tables live and in which format."""

    root: str
    fmt: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return readers.lake_table(spark, self.path(table), self.fmt)

    def write(
        self,
        df: DataFrame,
        table: str,
        partitions: tuple[str, ...] = (),
        rebalance: bool = True,
    ) -> int:
        """Replace a table; returns the rows it holds afterwards.

        Rows that are already stored by the same partitions need no ``rebalance``.
        """
        sinks.replace_all(df, self.path(table), partitions, self.fmt, rebalance)
        return sinks.stored_rows(df.sparkSession, self.path(table), self.fmt)


FACT_PARTITIONS = ("year", "month")


def weather_job(spark: SparkSession, lake: Lake, reports: DataFrame) -> int:
    hourly = weather.hourly_weather(weather.decode_reports(reports))
    return lake.write(hourly, "silver/weather")


def metered_silver_job(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Kept and rejected rows: one scan of bronze for each branch."""
    parts = silver.metered_silver(lake.read(spark, "bronze/metered"))
    return {
        "kept": lake.write(parts.kept, "silver/metered", sinks.PARTITIONS),
        "dead_letters": lake.write(parts.dead_letters, "dead_letter/metered"),
    }


def ride_hail_silver_job(spark: SparkSession, lake: Lake) -> dict[str, int]:
    parts = silver.ride_hail_silver(lake.read(spark, "bronze/ride_hail"))
    return {
        "kept": lake.write(parts.kept, "silver/ride_hail", sinks.PARTITIONS),
        "dead_letters": lake.write(parts.dead_letters, "dead_letter/ride_hail"),
    }


def stream_silver_job(spark: SparkSession, lake: Lake, hourly_path: str) -> dict[str, int]:
    """Silver of the raw messages; weather is joined when its file is there.

    Payloads are decoded once, into a table of typed messages that both branches read.
    """
    lake.write(silver.stream_trips(lake.read(spark, "bronze/messages")), "silver/messages_typed")
    parts = silver.stream_branches(
        lake.read(spark, "silver/messages_typed"),
        readers.optional_hourly_weather(spark, hourly_path),
    )
    letters = lake.path("dead_letter/messages")
    return {
        "kept": lake.write(parts.kept, "silver/messages"),
        "dead_letters": sinks.write_dead_letters(parts.dead_letters, letters, lake.fmt),
    }


def star_job(spark: SparkSession, lake: Lake, zones: DataFrame) -> DataFrame:
    """Staging as a view, the star as tables; returns the results of the checks."""
    staged = gold.staging(lake.read(spark, "silver/messages"))
    sinks.materialise(staged, "stg_silver_trips", "view")
    built = gold.star_tables(spark.table("stg_silver_trips"), zones)
    for name, df in built.items():
        lake.write(df, f"star/{name}")
    stored = {name: lake.read(spark, f"star/{name}") for name in built}
    return gold.check_star({"stg_silver_trips": spark.table("stg_silver_trips")} | stored)


def enrich_job(spark: SparkSession, lake: Lake) -> int:
    """The stored weather is small enough to be broadcast by its file size."""
    enriched = silver.enriched_metered(
        lake.read(spark, "silver/metered"), lake.read(spark, "silver/weather")
    )
    return lake.write(enriched, "silver/metered_enriched", sinks.PARTITIONS, rebalance=False)


def gold_job(
    spark: SparkSession, lake: Lake, zones: DataFrame, first_day: str, last_day: str
) -> dict[str, int]:
    metered = gold.metered_fact(lake.read(spark, "silver/metered_enriched"))
    ride_hail = gold.ride_hail_fact(lake.read(spark, "silver/ride_hail"))
    calendar = gold.calendar(readers.calendar_range(spark, first_day, last_day))
    facts = {"fact_trips_yellow": metered, "fact_trips_fhvhv": ride_hail}
    return {
        name: lake.write(fact, f"gold/{name}", FACT_PARTITIONS, rebalance=False)
        for name, fact in facts.items()
    } | {
        "dim_time": lake.write(calendar, "gold/dim_time"),
        "dim_zone": lake.write(zones, "gold/dim_zone"),
    }


def summary_job(spark: SparkSession, lake: Lake) -> list[str]:
    """One scan per fact into stored cells, then every summary from the cells."""
    lake.write(summary.summary_cells(lake.read(spark, "gold/fact_trips_yellow")), "cells/metered")
    lake.write(
        summary.ride_hail_cells(lake.read(spark, "gold/fact_trips_fhvhv")), "cells/ride_hail"
    )
    tables = summary.all_summaries(
        lake.read(spark, "cells/metered"),
        lake.read(spark, "cells/ride_hail"),
        lake.read(spark, "gold/dim_zone"),
    )
    for name, df in tables.items():
        lake.write(df, f"serving/{name}")
    return list(tables)


def answer_job(spark: SparkSession, lake: Lake, **periods) -> list[str]:
    stored = {
        name: lake.read(spark, f"serving/{name}")
        for name in catalogue.SERVING_TABLES
        if not name.startswith("answer_")
    }
    tables = answers.all_answers(stored, **periods)
    for name, df in tables.items():
        lake.write(df, f"serving/{name}")
    return list(tables)


def serve(spark: SparkSession, lake: Lake) -> tuple[list[str], list[str]]:
    """Register gold and serving tables as views; names found and names skipped."""
    found, skipped = catalogue.register_folder(
        spark, lake.path("serving"), catalogue.SERVING_TABLES, lake.fmt
    )
    more, fewer = catalogue.register_folder(
        spark, lake.path("gold"), catalogue.GOLD_TABLES, lake.fmt
    )
    return found + more, skipped + fewer
