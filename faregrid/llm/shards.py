"""Shuffle and sharding by a Feistel permutation of global row numbers.

Every row gets a number in ``doc_id`` order. A keyed four-round Feistel network on
the smallest even-bit domain that holds all numbers, walked until the value falls
below the row count, is a permutation of those numbers: place ``p`` goes to shard
``p mod shards``, slot ``p div shards``. Counts of shards differ by one at most, slots
have no gaps, and place and row number can be computed from each other without data.

Defined results: null texts count as empty; rows with equal ``doc_id`` are ordered by
checksum and size, so only rows alike in all three can swap; a null ``doc_id`` sorts
first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm.ship import ship
from faregrid.session import staged

ROUNDS = 4
SEED = 20_240_229
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _round(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    x = (half + np.uint64(key)) * _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) & mask


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.default_rng(seed).integers(0, 2**63, ROUNDS)]


def _half_bits(count: int) -> int:
    return max(1, ((max(count, 2) - 1).bit_length() + 1) // 2)


def permute(numbers: np.ndarray, count: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """A permutation of ``0 .. count-1`` applied to ``numbers``; ``back`` undoes it.

    The domain is at most four times ``count``, so few walks are needed.
    """
    bits = np.uint64(_half_bits(count))
    mask = np.uint64((1 << int(bits)) - 1)
    keys = _keys(seed)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        if back:
            for key in reversed(keys):
                left, right = right ^ _round(left, key, mask), left
        else:
            for key in keys:
                left, right = right, left ^ _round(right, key, mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= count]
    return out.astype(np.int64)


def place(number: int, count: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of a row number, without reading data."""
    slot, shard = divmod(int(permute(np.asarray([number]), count, seed)[0]), shards)
    return shard, slot


def row_at(shard: int, slot: int, count: int, shards: int, seed: int = SEED) -> int:
    """Row number that stands at a shard and slot."""
    return int(permute(np.asarray([slot * shards + shard]), count, seed, back=True)[0])


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` from 0 in the given order, and their count.

    Rows are ordered by range and written once with their place in their partition;
    the rest is one small row per partition, never all rows in one task.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbers = F.monotonically_increasing_id()  # partition in the upper bits, place below
    stored = staged(ordered.withColumn("_at", numbers), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = stored.groupBy(part).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        sizes.select("*", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")),
        "starts",
    )
    count = starts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    place_in_part = F.col("_at").bitwiseAND((1 << 33) - 1)
    joined = stored.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return (
        joined.withColumn("row_number", F.col("_before") + place_in_part).drop(
            "_at", "_part", "_n", "_before"
        ),
        int(count),
    )


def sharded(docs: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Shard and slot of every document; text is read but never moved."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows, count = numbered(narrow, "doc_id", "text_crc32", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = permute(batch.column("row_number").to_numpy(), count, seed)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["shard"] = pa.array((at % shards).astype(np.int32))
            columns["slot"] = pa.array(at // shards)
            yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    ship(rows.sparkSession)
    placed = rows.mapInArrow(run, f"{schema}, shard int, slot bigint")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
