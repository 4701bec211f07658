"""Ingest of monthly file drops with drifting schemas."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregrid.operators.conform import conform, scan_accepts, scan_schema, schema_drift
from faregrid.sources.sinks import PARTITIONS, replace_partitions

# footers are read for this many drops at a time
AT_ONCE = 16


@dataclass(frozen=True)
class Drop:
    year: int
    month: int
    path: str

    @property
    def label(self) -> str:
        return f"{self.year}-{self.month:02d}"


@dataclass
class Part:
    """Files of one drop with one physical schema."""

    drop: Drop
    files: list[str]
    schema: T.StructType


@dataclass
class Inspected:
    """The readable parts of the drops and the reasons of the others."""

    drops: list[Drop]
    parts: list[Part]
    failures: dict[Drop, str]

    def without(self, drop: Drop, reason: str) -> Inspected:
        left = [p for p in self.parts if p.drop != drop]
        return Inspected(self.drops, left, {**self.failures, drop: reason})


def _reason(problem: Exception) -> str:
    """The innermost message, which tells what was wrong with the file."""
    causes = re.findall(r"Caused by: (.+)", str(problem))
    return (causes[-1] if causes else str(problem)).splitlines()[0]


def _named(spark: SparkSession, file: str) -> str:
    """A file as the scan names it: escaped."""
    return _comparable(spark._jvm.org.apache.hadoop.fs.Path(file).toUri().toString())


def _comparable(path: str) -> str:
    """Paths are written with one to three slashes behind the scheme."""
    return re.sub(r"^([a-z][a-z0-9+.-]*):/+", r"\1:/", path)


def _files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a path; only the listing is read."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    listed, found = system.listFiles(root, True), []
    while listed.hasNext():
        file = listed.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString())
    return sorted(found)


def _inspect_one(spark: SparkSession, drop: Drop) -> list[Part]:
    """All footers of a drop in one distributed read; file by file if they conflict."""
    files = _files(spark, drop.path)
    try:
        return [Part(drop, files, spark.read.option("mergeSchema", True).parquet(*files).schema)]
    except Exception as problem:
        if "CANNOT_MERGE" not in str(problem) and "merge" not in str(problem):
            raise
    apart: dict[str, Part] = {}
    for file in files:
        schema = spark.read.parquet(file).schema
        apart.setdefault(schema.simpleString(), Part(drop, [], schema)).files.append(file)
    return list(apart.values())


def inspect(spark: SparkSession, drops: Sequence[Drop]) -> Inspected:
    """Footers of every file of every drop, before any data is read.

    Missing or damaged drops are found here. Several drops are looked at at a time.
    """
    if len({(d.year, d.month) for d in drops}) < len(drops):
        raise ValueError("two drops of one month")
    parts: list[Part] = []
    failures: dict[Drop, str] = {}
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for drop, looked in [(d, pool.submit(_inspect_one, spark, d)) for d in drops]:
            try:
                parts += looked.result()
            except Exception as problem:  # a bad drop is reported and must not stop the others
                failures[drop] = _reason(problem)
    return Inspected(list(drops), parts, failures)


def drift(
    spark: SparkSession, seen: Inspected, types: Mapping[str, T.DataType]
) -> DataFrame:
    """Differences of each part of each drop from the registered types."""
    found = [
        schema_drift(spark, {p.drop.label: p.schema}, types) for p in seen.parts
    ]
    return reduce(DataFrame.unionByName, found).distinct()


def _tagged(scan: DataFrame, parts: Sequence[Part]) -> DataFrame:
    """Year and month of the drop a row's file belongs to; any other file is an error."""
    spark = scan.sparkSession
    tags = spark.createDataFrame(
        [
            (_named(spark, f), p.drop.year, p.drop.month)
            for p in parts
            for f in p.files
        ],
        "_file string, puYear int, puMonth int",
    )
    known = [c for c in scan.columns if c.lower() not in ("puyear", "pumonth")]
    path = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z][a-z0-9+.-]*):/+", "$1:/")
    named = scan.select(*known, path.alias("_path"))
    missing = F.raise_error(F.concat(F.lit("no drop for file "), F.col("_path"))).cast("int")
    # one row per file: the planner knows its size
    joined = named.join(tags, F.col("_path") == F.col("_file"), "left")
    return joined.select(
        *known, F.coalesce("puYear", missing).alias("puYear"), "puMonth"
    )


def read_drops(
    spark: SparkSession, seen: Inspected, types: Mapping[str, T.DataType]
) -> DataFrame:
    """All readable drops, conformed and tagged with their year and month.

    Files whose columns the scan can widen are read together in one scan with the
    canonical schema. The others are grouped by physical schema and cast after
    reading: one more scan per distinct schema, however many drops.
    """
    wanted = scan_schema([p.schema for p in seen.parts], types)
    together = [p for p in seen.parts if scan_accepts(p.schema, wanted)]
    apart: dict[str, list[Part]] = {}
    for part in seen.parts:
        if part not in together:
            apart.setdefault(part.schema.simpleString(), []).append(part)

    def scan_of(parts: list[Part], schema: T.StructType) -> DataFrame:
        files = [f for p in parts for f in p.files]
        return _tagged(spark.read.schema(schema).parquet(*files), parts)

    scans = [scan_of(together, wanted)] if together else []
    every = {f.name: f.dataType for f in wanted.fields if f.name not in PARTITIONS}
    for group in apart.values():
        scans.append(conform(scan_of(group, group[0].schema), every))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def ingest_report(
    spark: SparkSession, seen: Inspected, written: DataFrame | None
) -> DataFrame:
    """One row per expected drop: status, rows landed now, and why it failed if it did."""
    expected = spark.createDataFrame(
        [
            (d.year, d.month, "failed" if d in seen.failures else "ok", seen.failures.get(d))
            for d in seen.drops
        ],
        "year int, month int, status string, reason string",
    )
    none = F.lit(0).cast("bigint")
    if written is None:
        return expected.withColumn("rows", none)
    landed = [d for d in seen.drops if d not in seen.failures]
    years = F.col("puYear").isin(sorted({d.year for d in landed}))
    months = F.col("puMonth").isin(sorted({d.month for d in landed}))
    counts = (
        written.filter(years & months)
        .groupBy(F.col("puYear").alias("year"), F.col("puMonth").alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return expected.join(counts, ["year", "month"], "left").withColumn(
        "rows", F.when(F.col("status") == "ok", F.coalesce("rows", none)).otherwise(none)
    )


def _damaged(spark: SparkSession, problem: Exception, seen: Inspected) -> Drop | None:
    """The drop of the file a read failed on; None for any other failure."""
    named = re.search(r"FAILED_READ_FILE.*?file (\S+?)[.,]?\s", str(problem), re.S)
    if named is None:
        return None
    path = _comparable(named[1])
    return next(
        (
            p.drop
            for p in seen.parts
            if any(path in (_comparable(f), _named(spark, f)) for f in p.files)
        ),
        None,
    )


def ingest(
    spark: SparkSession,
    drops: Sequence[Drop],
    types: Mapping[str, T.DataType],
    target: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Land all readable drops with one write and return the report.

    Every drop replaces its own (year, month) partition, so a repeated run does
    not add rows twice. Rows are tagged by the drop their file belongs to, whatever
    its name. When the write fails on a damaged file, its drop is reported as failed
    and the others are written without it; any other failure is raised.
    """
    seen = inspect(spark, drops)
    while seen.parts:
        try:
            replace_partitions(read_drops(spark, seen, types), target, PARTITIONS, fmt)
            break
        except Exception as problem:
            bad = _damaged(spark, problem, seen)
            if bad is None:
                raise
            seen = seen.without(bad, _reason(problem))
    return ingest_report(spark, seen, spark.read.format(fmt).load(target) if seen.parts else None)


def partition_audit(table: DataFrame) -> DataFrame:
    """Rows per drop, in calendar order."""
    return (
        table.groupBy(*PARTITIONS)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(*PARTITIONS)
    )
