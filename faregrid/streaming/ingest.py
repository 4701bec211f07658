"""Continuous ingest of messages into the raw envelope table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from faregrid.operators.envelope import raw_envelope

BATCH_INTERVAL = "30 seconds"


def start_raw_ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str = BATCH_INTERVAL,
    drain: bool = False,
) -> StreamingQuery:
    """Append envelopes to the raw table, resuming from the checkpoint.

    ``drain`` processes what is available and ends; otherwise a batch starts at
    every interval.
    """
    writer = (
        raw_envelope(messages)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start(path)


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; an interrupt stops it cleanly between batches."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        query.stop()


def drain_raw_ingest(messages: DataFrame, path: str, checkpoint: str) -> None:
    start_raw_ingest(messages, path, checkpoint, drain=True).awaitTermination()
