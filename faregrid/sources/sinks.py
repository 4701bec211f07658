"""Writers: partitioned, full replace, dead letters, CSV and materialisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = ("puYear", "puMonth")


def clustered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Ask AQE to group rows by partition: hot partitions are split, small ones merged."""
    return df.hint("rebalance", *[F.col(p) for p in partitions])


def append_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS, fmt: str = "parquet"
) -> None:
    """Append only; readers merge columns that later drops add."""
    writer = df.write.format(fmt).mode("append").option("mergeSchema", "true")
    writer.partitionBy(*partitions).save(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = PARTITIONS,
    fmt: str = "parquet",
    rebalance: bool = False,
) -> None:
    """Replace just the partitions present in ``df``: a repeated run adds nothing twice."""
    rows = clustered(df, partitions) if rebalance else df
    writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).save(path)


def replace_all(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    fmt: str = "parquet",
    rebalance: bool = True,
) -> None:
    """Replace the whole table, its schema included."""
    rows = clustered(df, partitions) if partitions and rebalance else df
    writer = rows.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    writer = writer.option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def stored_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Rows of a stored table, from its footers.

    Counting what was written stays right when tasks were repeated after a lost
    executor, and costs no second run of the plan that produced the rows.
    """
    return spark.read.format(fmt).load(path).count()


def write_dead_letters(rejected: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace the failed rows with those of this run, none included; returns how many."""
    replace_all(rejected, path, fmt=fmt)
    return stored_rows(rejected.sparkSession, path, fmt)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def materialise(df: DataFrame, name: str, kind: str, path: str | None = None) -> None:
    """Staging models become views, finished models become tables, at ``path`` if given."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        raise ValueError(f"unknown kind of model: {kind}")
