"""Silver of the message path as a stream, with bounded state and writes that can be repeated.

Duplicates are removed by the state of the stream: a business key is remembered until the
arrival time of messages has passed it by ``delay``. Arrival times come from the broker, so a
wrong time inside a payload cannot move the watermark. A failing row has its place in the topic
and its content for a key, so only the same message twice counts as a repeat.

The state has a row per key of the delay. It lies on the disks of the executors (RocksDB) within
``STATE_SETTINGS``, not in their heap, of which a restarted query would need two copies. A run
that drains a backlog opens a partition of the state for its task only (``DRAIN_SETTINGS``), so
one packed copy lies in the checkpoint and hardly any beside it. A setting the session has
already, and the store a checkpoint was begun with, go first.

Every micro-batch is one write, kept rows and dead letters side by side, into the folder of
its batch number. A batch that is repeated after a failure replaces its folder: nothing is
written twice, whichever step the failure came after. Counts of a batch are written after
its rows, in the same way.

A message that arrives later than ``delay`` behind the newest one is not looked up in the
state any more and not written. Spark counts such rows per batch (``dropped``); ``missing``
finds them in the raw table, for they are in no branch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faregrid.operators import dedup, quality
from faregrid.operators.envelope import decode_payload, raw_envelope
from faregrid.plans.onepass import FAILED, KEPT, OUTCOME, branches
from faregrid.plans.silver import Silver, stream_features, stream_trips
from faregrid.streaming.ingest import BATCH_INTERVAL

DELAY = "1 day"
BATCH = "batch"
ARRIVED = "kafka_timestamp"
RULES = quality.STREAM_RULES
_STORE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    # a look-up per key, only for a number nobody reads
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.rocksdb.compression": "zstd",
    # else some 4 MB are set aside for every partition of the state, each time it is opened
    f"{_STORE}.rocksdb.allowFAllocate": "false",
}
# a partition of the state leaves the disk of its executor when its task ends
DRAIN_SETTINGS = {f"{_STORE}.unloadOnCommit": "true"}
BATCH_SETTINGS = {
    # shuffle files go when their batch ends, not when the driver collects its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
_OWN = "__own_key"
_STAMPS = ("ingestion_timestamp", "silver_timestamp")


def _flagged(decoded: DataFrame) -> DataFrame:
    return quality.with_flags(stream_features(decoded), RULES)


def judged(messages: DataFrame, delay: str = DELAY) -> DataFrame:
    """Messages with flags and outcome, each business key once within ``delay``.

    Only typed fields and keys are shuffled: features and flags are taken again behind the
    state, and the two stamps are one moment of the whole batch.
    """
    decoded = decode_payload(raw_envelope(messages), keep=[ARRIVED])
    flagged = _flagged(decoded)
    content = [c for c in flagged.columns if c not in _STAMPS]
    own = F.concat_ws(":", "kafka_partition", "kafka_offset", F.xxhash64(*content))
    once = (
        flagged.withColumn(_OWN, F.when(~F.col("is_valid"), own))
        .select(*[c for c in decoded.columns if c not in _STAMPS], _OWN)
        .withWatermark(ARRIVED, delay)
        .dropDuplicatesWithinWatermark([*dedup.STREAM_KEYS, _OWN])
        .drop(_OWN)
    )
    stamped = once.withColumns(dict.fromkeys(_STAMPS, F.current_timestamp()))
    return (
        _flagged(stamped)
        .select(*flagged.columns)
        .withColumn(OUTCOME, F.when(F.col("is_valid"), KEPT).otherwise(FAILED))
    )


def _batch_path(path: str, number: int) -> str:
    return f"{path}/{BATCH}={number}"


def batch_writer(
    path: str, counts: str, fmt: str = "parquet", between: Callable[[int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """The function of a micro-batch: rows first, then their counts.

    ``between`` is called after the rows are written, with the number of the batch.
    """

    def write(rows: DataFrame, number: int) -> None:
        own = _batch_path(path, number)
        writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(OUTCOME).save(own)
        if between:
            between(number)
        stored = rows.sparkSession.read.format(fmt).schema(rows.schema).load(own)
        tally = stored.groupBy(OUTCOME).agg(F.count(F.lit(1)).alias("rows"))
        tally.coalesce(1).write.format(fmt).mode("overwrite").save(_batch_path(counts, number))

    return write


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """``settings`` for queries started meanwhile, which keep the settings they start with."""
    own = [key for key in settings if spark.conf.get(key, None) is None]
    for key in own:
        spark.conf.set(key, settings[key])
    try:
        yield
    finally:
        for key in own:
            spark.conf.unset(key)


def start_silver(
    messages: DataFrame,
    path: str,
    counts: str,
    checkpoint: str,
    delay: str = DELAY,
    interval: str = BATCH_INTERVAL,
    drain: bool = False,
    fmt: str = "parquet",
    between: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start or resume the stream; ``drain`` ends when what is available is written."""
    writer = (
        judged(messages, delay)
        .writeStream.foreachBatch(batch_writer(path, counts, fmt, between))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    settings = STATE_SETTINGS | BATCH_SETTINGS | (DRAIN_SETTINGS if drain else {})
    with _settings(messages.sparkSession, settings):
        return writer.start()


def drain_silver(messages: DataFrame, path: str, counts: str, checkpoint: str, **options) -> dict[str, int]:
    """Write what is available; rows the state dropped, as ``late`` and ``repeated``."""
    query = start_silver(messages, path, counts, checkpoint, drain=True, **options)
    query.awaitTermination()
    return dropped(query)


def dropped(query: StreamingQuery) -> dict[str, int]:
    """Rows dropped as too late and as repeated, over the progress Spark keeps of a query."""
    states = [s for p in query.recentProgress for s in p.stateOperators]
    return {
        "late": sum(s.numRowsDroppedByWatermark for s in states),
        "repeated": sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in states),
    }


def stored_silver(spark: SparkSession, path: str, fmt: str = "parquet") -> Silver:
    """Both branches of all batches."""
    parts = branches(spark, path, RULES, fmt)
    return Silver(parts.kept.drop(BATCH), parts.dead_letters.drop(BATCH))


def missing(envelope: DataFrame, stored: Silver) -> DataFrame:
    """Valid messages of the raw table whose business key is in no stored row.

    Keys are compared null-safe; only keys of both sides are shuffled beside the raw rows.
    """
    valid = quality.passed(stream_trips(envelope), RULES)
    keys = stored.kept.select(*[F.col(k).alias(f"_{k}") for k in dedup.STREAM_KEYS])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in dedup.STREAM_KEYS])
    return valid.join(keys, same, "left_anti")
