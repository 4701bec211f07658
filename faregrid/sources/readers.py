"""Batch and streaming readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from faregrid.operators.envelope import MESSAGE_SCHEMA

# Columns of the typed hourly weather file and of a station report.
HOURLY_WEATHER_SCHEMA = "date string, hour int, temperature double, precipitation double, wind_speed double, condition string"
STATION_REPORT_SCHEMA = "DATE string, TMP string, WND string, AA1 string"

# Lookup file header -> zone dimension.
ZONE_LOOKUP_SCHEMA = "LocationID bigint, Borough string, Zone string, service_zone string"
ZONE_RENAMES = {
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
    "service_zone": "service_zone",
}


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Unbounded message topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def message_folder_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """The same message columns from files landing in a folder."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def lake_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table; ``fmt`` may name any format on the class path."""
    return spark.read.format(fmt).load(path)


def hourly_weather_file(spark: SparkSession, path: str) -> DataFrame:
    """Typed hourly weather with its declared schema (no inference pass)."""
    return spark.read.schema(HOURLY_WEATHER_SCHEMA).option("header", True).csv(path)


def optional_hourly_weather(spark: SparkSession, path: str) -> DataFrame | None:
    """The hourly file, or None when there is none to enrich with."""
    try:
        return hourly_weather_file(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def station_reports(
    spark: SparkSession, pattern: str, columns: str | None = None
) -> DataFrame:
    """All report files of a glob, every column as text.

    The header names the columns unless ``columns`` declares them; only the
    columns that are used are parsed.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(columns)
    return reader.csv(pattern)


def zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup file as the zone dimension; the text ``N/A`` stays a text."""
    raw = spark.read.schema(ZONE_LOOKUP_SCHEMA).option("header", True).csv(path)
    return raw.withColumnsRenamed(ZONE_RENAMES)


def rows_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small driver-side rows as a DataFrame with a declared schema.

    They go over as an Arrow table, so the planner knows their size; rows of an RDD count as
    unboundedly large, and a join would broadcast or shuffle the other side instead.
    """
    declared = T.StructType.fromDDL(schema)
    cells = [dict(zip(declared.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(cells, to_arrow_schema(declared)), declared)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).upper() if isinstance(value, bool) else repr(value)


def values_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Inline VALUES table with named columns; the planner knows its exact size."""
    cells = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {cells} AS t({', '.join(columns)})")


def calendar_days(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day between the two dates of a one-row frame, both included."""
    return bounds.select(
        F.explode(
            F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))
        ).alias("date")
    )


def calendar_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first_day"), F.lit(last).cast("date").alias("last_day")
    )
    return calendar_days(bounds)


def describe_columns(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """Schemas as data: table, position, column and type."""
    rows = [
        (name, position, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, column_type string"
    )
