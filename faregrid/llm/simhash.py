"""SimHash fingerprints linked through the anchors of a covering code.

Fingerprints that differ in at most ``DISTANCE`` (4) of 64 bits are linked. The 64 bits
are three blocks of 21 or 22 bits; of 4 differing bits at most 2 lie in the best two
blocks. Each block, filled up with zeros to 23 bits, is covered by the words of the
binary Golay code: every value lies within the covering radius 3 of exactly one code
word. The anchors of a pair of blocks are pairs of code words, 2**24 of them.

Two values that differ in 2 bits have a value between them, 1 bit from either; its
anchor is within radius + 1 of both. So it is enough to copy each fingerprint to all
anchors within radius plus half the threshold of a pair, 1: some 10 anchors for each of
the three pairs. Fingerprints are compared anchor by anchor with their whole 64 bits.

Copies never meet: equal fingerprints are one node, made by an aggregation. Within an
anchor the links are walked breadth first over those not yet reached, which yields one
link per node reached instead of all pairs of a dense group; no link is lost for the
components.

Defined results: a null, empty or blank text has fingerprint zero and is linked like
any other; fewer words than a shingle count as one shingle; ``component_id`` is the
smallest non-null ``doc_id`` reachable, null where a component has none; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm.components import components
from faregrid.llm.ship import ship
from faregrid.llm.words import put_back, set_aside
from faregrid.session import staged

SHINGLE = 4
SEED = 42
DISTANCE = 4
BLOCKS = ((0, 21), (21, 21), (42, 22))  # first bit, bits
PAIRS = ((0, 1), (0, 2), (1, 2))
RADIUS = 3
REACH = 1

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BITS = np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit b is set where more than half of the shingle hashes have it set."""
    found = _WORD.findall((text or "").encode().translate(_LOWER))
    if not found:
        return 0
    if len(found) < shingle:
        grams = [b" ".join(found)]
    else:
        grams = map(b" ".join, zip(*[found[i:] for i in range(shingle)], strict=False))
    hash_of = xxhash.xxh64_intdigest
    return majority(np.asarray([hash_of(g, SEED) for g in grams], dtype=">u8"))


def majority(hashes: np.ndarray) -> int:
    """Bit b is set where more than half of ``hashes`` (big-endian, 64 bits) have it set."""
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 4096):  # bits unpacked piece by piece
        part = hashes[start : start + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    most = 2 * ones > len(hashes)
    return int((most.astype(np.uint64) << _BITS).sum())


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py()) for t in batch.column("text")),
                dtype=np.uint64,
                count=batch.num_rows,
            )
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))}
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fp bigint")


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, list[np.ndarray]]:
    """Syndrome of every 23-bit value, and per syndrome the patterns within RADIUS + REACH.

    A pattern added to a value with its syndrome gives a code word; patterns are
    sorted by weight, and the first is the only one within RADIUS.
    """
    generator = 0b101011100011  # of the cyclic (23, 12) code
    unit = np.zeros(23, dtype=np.int64)
    for bit in range(23):
        rest = 1 << bit
        for high in range(22, 10, -1):
            if rest >> high & 1:
                rest ^= generator << (high - 11)
        unit[bit] = rest
    syndrome = np.zeros(1, dtype=np.int16)
    for bit in range(23):
        syndrome = np.concatenate([syndrome, syndrome ^ np.int16(unit[bit])])
    weight = np.bitwise_count(np.arange(1 << 23, dtype=np.uint32))
    (near,) = np.nonzero(weight <= RADIUS + REACH)
    near = near[np.lexsort((near, weight[near], syndrome[near]))]
    edges = np.searchsorted(syndrome[near], np.arange(2049))
    return syndrome, [near[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index into ``fps`` and anchor key for every copy of a fingerprint."""
    syndrome, patterns = golay()
    first = np.asarray([p[0] for p in patterns])
    counts = np.asarray([len(p) - 1 for p in patterns])
    flat = np.concatenate([p[1:] for p in patterns])
    offset = np.cumsum(counts) - counts
    homes, nexts = [], []
    for start, bits in BLOCKS:
        value = (fps >> np.uint64(start)).astype(np.int64) & ((1 << bits) - 1)
        s = syndrome[value].astype(np.int64)
        homes.append((value ^ first[s]) >> 11)  # the upper 12 bits tell the code word
        n = counts[s]
        row = np.repeat(np.arange(len(fps)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        nexts.append((row, (value[row] ^ flat[offset[s][row] + step]) >> 11))
    every = np.arange(len(fps))
    rows, keys = [], []
    for number, (a, b) in enumerate(PAIRS):
        for row, left, right in (
            (every, homes[a], homes[b]),
            (nexts[a][0], nexts[a][1], homes[b][nexts[a][0]]),
            (nexts[b][0], homes[a][nexts[b][0]], nexts[b][1]),
        ):
            rows.append(row)
            keys.append((number << 24) | (left << 12) | right)
    return np.concatenate(rows), np.concatenate(keys)


def _walk(fps: np.ndarray) -> tuple[list[int], list[int]]:
    """Links (as places in ``fps``) of a spanning forest of one anchor's fingerprints."""
    left, right = [], []
    rest = np.arange(len(fps))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(fps[rest] ^ fps[at]) <= DISTANCE
            reached, rest = rest[near], rest[~near]
            queue.extend(reached)
            left.extend([at] * len(reached))
            right.extend(reached)
    return left, right


def _links_of(keys: np.ndarray, fps: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    """Links within whole anchors; rows are sorted by key."""
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    sizes = np.diff(edge)
    left, right = [], []
    # anchors of up to eight: neighbours at each offset, for all anchors at once
    group = np.repeat(np.arange(len(sizes)), sizes)
    small = sizes <= 8
    for offset in range(1, 8):
        if len(keys) <= offset:
            break
        same = (group[offset:] == group[:-offset]) & small[group[offset:]]
        (at,) = np.nonzero(same)
        at = at[np.bitwise_count(fps[at] ^ fps[at + offset]) <= DISTANCE]
        left.append(nodes[at])
        right.append(nodes[at + offset])
    for number in np.flatnonzero(~small):
        lo, hi = edge[number], edge[number + 1]
        a, b = _walk(fps[lo:hi])
        left.append(nodes[lo:hi][a])
        right.append(nodes[lo:hi][b])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())}
    )


def links(nodes: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that span all fingerprints (``node``, ``fp``) within DISTANCE."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            ids = batch.column("node").to_numpy()
            rows, keys = anchors(fps)
            for start in range(0, len(rows), 1 << 16):
                row = rows[start : start + (1 << 16)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": pa.array(keys[start : start + (1 << 16)].astype(np.int32)),
                        "fp": pa.array(fps[row].view(np.int64)),
                        "node": pa.array(ids[row]),
                    }
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            keys, fps, ids = (batch.column(c).to_numpy() for c in ("anchor", "fp", "node"))
            if not len(keys):
                continue
            held.append((keys, fps.view(np.uint64), ids))
            if keys[-1] == held[0][0][0]:
                continue  # all of one anchor so far
            joined = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(joined[0], joined[0][-1]))  # the last anchor goes on
            yield _links_of(*[x[:cut] for x in joined])
            held = [tuple(x[cut:] for x in joined)]
        if held:
            yield _links_of(*[np.concatenate(x) for x in zip(*held, strict=True)])

    copies = nodes.select("node", "fp").mapInArrow(spread, "anchor int, fp bigint, node bigint")
    sorted_copies = copies.repartition("anchor").sortWithinPartitions("anchor")
    return sorted_copies.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every document (``doc_id`` an integer).

    Texts are read once; everything after moves 8-byte fingerprints. A node is a
    distinct fingerprint.
    """
    ship(docs.sparkSession)
    marked = staged(fingerprints(docs), "fingerprints")
    nodes = staged(
        marked.groupBy("fp").agg(F.min(F.col("doc_id").cast("bigint")).alias("first_id")),
        "nodes",
    )
    # the fingerprint names the node; ids may be null or shared
    found = components(links(nodes.select(F.col("fp").alias("node"), "fp")))
    member = (
        nodes.join(found, F.col("fp") == F.col("node"), "left")
        .select("fp", "first_id", F.coalesce("component", "fp").alias("root"))
    )
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = staged(member.join(least, "root").select("fp", "component_id"), "labels")
    return marked.join(label, "fp").select(
        F.col("doc_id"), "fp", F.col("component_id").cast(docs.schema["doc_id"].dataType)
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of every group of near copies its smallest ``doc_id``.

    Groups are those of ``nearcopies`` (five-word shingles, similarity 0.8 or more); the
    fingerprints and constants above are those of op8 only. Rows are told apart by
    ``doc_id`` and text, so an id that other texts share takes none of them along. A row
    repeated with the same ``doc_id`` and text stays once; rows without a ``doc_id`` cannot be
    named as copies of another and stay, equal texts once.
    """
    from faregrid.llm.nearcopies import near_copies  # it uses the words of this module

    judged = near_copies(docs)
    stands = (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    gone = judged.filter(~stands).select(
        F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_text")
    )
    whole, names = set_aside(docs, "doc_id", "text")
    copy = (F.col("doc_id") == F.col("_gone")) & (F.xxhash64("text") == F.col("_gone_text"))
    left = whole.join(gone.distinct(), copy, "left_anti")
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*names.values()))
    once = left.withColumn("_copy", F.row_number().over(same)).filter("_copy = 1")
    return put_back(once, names)
