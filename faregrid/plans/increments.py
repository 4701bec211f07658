"""Silver and summaries kept up to date drop by drop.

A drop is judged, freed of duplicates within itself and of keys that earlier drops have
brought, and written to a folder of its own, with its keys and its summary cells beside it.
Nothing of earlier drops is read but their keys. These lie in a table bucketed by key, so
the search for known keys shuffles the new drop only. Summaries are merged from the cells of all
drops; cells add up exactly, so they equal a full run.

Of a key that several drops bring, the first drop keeps it. A drop that is absorbed again, after a
failure or with other content, replaces its own rows, keys and cells; a drop that is sent
again under another name adds no row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.operators import quality
from faregrid.plans import summary
from faregrid.plans.jobs import Lake
from faregrid.plans.onepass import FAILED, KEPT, OUTCOME, Fleet, outcomes
from faregrid.sources import sinks

DROP = "drop_name"
KEY = "key_text"
BUCKETS = 64


def key_text(keys: list[str]) -> Column:
    """The values of a key as one text; equal texts are equal keys, NULL being a value."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.to_json(F.array(*parts))


@dataclass(frozen=True)
class DropStore:
    """Tables of one fleet below the root of a lake."""

    lake: Lake
    fleet: Fleet
    buckets: int = BUCKETS

    def folder(self, table: str, drop: str = "") -> str:
        path = self.lake.path(f"by_drop/{self.fleet.name}/{table}")
        return f"{path}/{DROP}={drop}" if drop else path

    def keys_table(self, spark: SparkSession) -> str:
        """Name of the table of stored keys, registered for this session if need be.

        The data lie below the root; the partitions of earlier sessions are found again.
        """
        place = self.folder("keys")
        name = f"known_keys_{hashlib.sha256(place.encode()).hexdigest()[:16]}"
        if not spark.catalog.tableExists(name):
            folder = spark._jvm.org.apache.hadoop.fs.Path(place)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
            spark.sql(
                f"CREATE TABLE {name} ({KEY} STRING, {DROP} STRING) USING parquet "
                f"PARTITIONED BY ({DROP}) CLUSTERED BY ({KEY}) INTO {self.buckets} BUCKETS "
                f"LOCATION '{place}'"
            )
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name


def unknown(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with a key that ``known`` has not; only ``rows`` are shuffled."""
    marked = rows.withColumn("_key", key_text(keys))
    return marked.join(known, F.col("_key") == F.col(KEY), "left_anti").drop("_key")


def absorb(
    spark: SparkSession,
    store: DropStore,
    drop: str,
    rows: DataFrame,
    fact_of: Callable[[DataFrame], DataFrame],
) -> dict[str, int]:
    """Take one drop in; returns its stored rows, dead letters and cells.

    ``fact_of`` makes the fact from kept rows. Rows are written first, then what is
    derived from the stored rows, so a drop stopped in between is completed by absorbing
    it again.
    """
    if not re.fullmatch(r"[\w.-]+", drop):
        raise ValueError(f"a drop is named by letters, digits, dots and dashes: {drop!r}")
    fmt, fleet = store.lake.fmt, store.fleet
    table = store.keys_table(spark)
    known = spark.table(table).filter(F.col(DROP) != drop).select(KEY)
    judged = outcomes(quality.with_flags(rows, fleet.rules), fleet)
    flags = [rule.flag for rule in fleet.rules] + ["is_valid"]
    kept_path, failed_path = store.folder("kept", drop), store.folder("failed", drop)
    staged_path = store.folder("judged", drop)
    sinks.replace_all(judged, staged_path, (OUTCOME,), fmt, rebalance=False)
    both = spark.read.format(fmt).schema(judged.schema).load(staged_path)
    fresh = unknown(both.filter(F.col(OUTCOME) == KEPT).drop(OUTCOME, *flags), known, list(fleet.keys))
    sinks.replace_all(fleet.features(fresh), kept_path, fmt=fmt)
    sinks.replace_all(
        fleet.features(both.filter(F.col(OUTCOME) == FAILED).drop(OUTCOME)), failed_path, fmt=fmt
    )
    kept = spark.read.format(fmt).load(kept_path)
    own = kept.select(key_text(list(fleet.keys)).alias(KEY))
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({DROP} = '{drop}') SELECT {KEY} FROM {{own}}", own=own
    )
    cells = summary.summary_cells(fact_of(kept))
    sinks.replace_all(cells, store.folder("cells", drop), fmt=fmt)
    return {
        name: sinks.stored_rows(spark, store.folder(name, drop), fmt) for name in ("kept", "failed", "cells")
    }


def all_drops(spark: SparkSession, store: DropStore, table: str) -> DataFrame:
    """``kept``, ``failed`` or ``cells`` of every absorbed drop."""
    return spark.read.format(store.lake.fmt).load(store.folder(table)).drop(DROP)
