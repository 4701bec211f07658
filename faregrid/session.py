"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# scratch paths of each application
_made: dict[str, list[str]] = {}

SETTINGS = {
    # timestamps are wall-clock values; one zone keeps them comparable
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "faregrid", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A session whose executors are threads of the driver, as in tests, gets a folder
    of its own where the setting is missing; on a cluster a machine-local folder
    would lose data with the machine, so a missing setting is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="faregrid-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed by ``clear_scratch``."""
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> tuple[str, ...]:
    """What this application has in the shared folder and has not removed."""
    return tuple(_made.get(spark.sparkContext.applicationId, ()))


def clear_scratch(spark: SparkSession, only: Iterable[str] | None = None) -> int:
    """Remove what this application left in the shared folder; results must be read before.

    ``only`` names the paths to remove. Returns how many paths there were.
    """
    made = _made.get(spark.sparkContext.applicationId, [])
    wanted = None if only is None else set(only)
    paths = [p for p in made if wanted is None or p in wanted]
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        made.remove(path)
    return len(paths)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage with files that survive executor loss, and gives Catalyst
    the real size of the data: a join against the result is broadcast only when
    the files are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
