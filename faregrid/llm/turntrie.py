"""Prefix trie of conversations with totals of every subtree.

A turn is named by 16 bytes of a digest of its role and text, a conversation by its path,
the names of its turns one after the other; texts are never shuffled. Equal paths are put
together first, their ids in pieces of a bounded range of ids, so that a conversation
copied a million times is one sequence and no list of its members is ever held whole.

Paths are dealt in ranges of their byte order, which are ranges of prefixes: two blocks
share only the nodes above the cut between them. Each block of a task packs its own
double-array trie over dense turn codes and walks all its sequences through it. Nodes
that no other block can have are final at once. Those on the way to the first or last path
of a block may be shared; their parts are summed over all blocks, and the totals of their
subtrees by doubling: in step k every node hands what it has gathered to its ancestor 2**k
levels up. The number of steps is the logarithm of the longest conversation.

Defined results: rows with a null ``conv_id`` belong to no conversation; null role or text
is empty; turns are in the order of ``turn``, null first, equal ones by role and then by
digest; the remainder of a negative id has its sign. An empty table has no root. The digest of the
members that end at a node is read in order of their ids in one task, piece by piece:
SHA-256 has no parallel form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm.doublearray import dense, nodes_of, pack
from faregrid.llm.ship import ship
from faregrid.session import staged

GROUP = 100  # conversations that share the turns of their first
MOST_SHARED = 5
PIECE = 4096  # ids a piece of a member list spans
BLOCK = 1 << 18  # turns of a double array
NAME = 16

NO_MEMBERS = hashlib.sha256(b"").hexdigest()

_PARTS = (
    "key binary, up binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint,"
    " n_children bigint, n_leaves bigint, saved_tokens bigint, chars bigint, ends_sha256 string"
)


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` and ``chars`` (code points of each turn) of every rebuilt conversation."""
    role, text = _text("role"), _text("text")
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    name = F.substring(F.unhex(F.sha2(named, 256)), 1, NAME)
    cells = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"), role.alias("role"), name.alias("name"),
            F.length(text).alias("chars"),
        ).alias("cell"),
    )
    own = staged(
        cells.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("cell")).alias("cells"))
        .select(
            "conv_id",
            F.transform("cells", lambda c: c["name"]).alias("names"),
            F.transform("cells", lambda c: c["chars"]).alias("chars"),
        ),
        "conversations",
    )
    first = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_first"),
        F.slice("names", 1, MOST_SHARED).alias("_names"),
        F.slice("chars", 1, MOST_SHARED).alias("_chars"),
    )
    shared = F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)
    met = own.withColumn("_h", shared.cast("int")).join(
        first, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("_first"), "left"
    )

    def spliced(mine: str, theirs: str, kind: str) -> Column:
        before = F.slice(F.coalesce(theirs, F.array().cast(kind)), F.lit(1), F.col("_h"))
        return F.concat(before, F.slice(mine, F.col("_h") + 1, F.greatest(F.size(mine), F.lit(1))))

    return met.select(
        "conv_id",
        F.array_join(
            F.transform(spliced("names", "_names", "array<binary>"), F.hex), ""
        ).alias("_hex"),
        spliced("chars", "_chars", "array<int>").alias("chars"),
    ).select("conv_id", F.unhex("_hex").alias("path"), "chars")


def _pieces(conversations: DataFrame) -> DataFrame:
    """Equal paths together: per ``path`` and range of ids the number, smallest and list of ids."""
    return conversations.groupBy("path", F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n"),
        F.first("chars").alias("chars"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Path, members, smallest member, code points and digest of ends of each path, in order."""
    now: list | None = None
    for batch in batches:
        for path, conv_id, n, chars, ids in zip(*(batch.column(c).to_pylist() for c in (
            "path", "conv_id", "n", "chars", "ids"
        )), strict=True):
            if now and now[0] == path:
                now[1] += n
                now[2] = min(now[2], conv_id)
                now[4].update(b"," + ids.encode())
                continue
            if now:
                yield (*now[:4], now[4].hexdigest())
            now = [path, n, conv_id, chars, hashlib.sha256(ids.encode())]
    if now:
        yield (*now[:4], now[4].hexdigest())


def _chain(up: bytes, name: bytes) -> bytes:
    return hashlib.blake2b(up + name, digest_size=NAME).digest()


ROOT = _chain(b"", b"")


def _block(sequences: list[tuple]) -> pa.RecordBatch:
    """The nodes of one block: those of its own whole, those it may share in part."""
    paths, members, least, chars, ends = zip(*sequences, strict=True)
    length = np.asarray([len(p) // NAME for p in paths])
    start = np.r_[0, np.cumsum(length)]
    names = np.frombuffer(b"".join(paths), dtype=f"V{NAME}")
    codes, most = dense(names.view(">u8").reshape(-1, 2).astype("u8").copy().view("V16").ravel())
    nodes = nodes_of(codes, start)
    trie = pack(nodes, most)

    count, first = np.asarray(members), np.asarray(least)
    n = len(nodes.parent)
    convs = np.zeros(n, dtype=np.int64)
    smallest = np.full(n, np.iinfo(np.int64).max)
    size = np.zeros(n, dtype=np.int64)
    flat = np.concatenate([np.asarray(c, dtype=np.int64) for c in chars]) if most else np.zeros(0, int)
    state = np.zeros(len(paths), dtype=np.int64)
    alive, level = np.arange(len(paths)), 0
    while len(alive):
        here = trie.node[state[alive]]
        np.add.at(convs, here, count[alive])
        np.minimum.at(smallest, here, first[alive])
        if level:
            size[here] = flat[start[alive] + level - 1]
        alive = alive[length[alive] > level]
        state[alive] = trie.step(state[alive], codes[start[alive] + level])
        level += 1

    shared = np.zeros(n, dtype=bool)
    keys: dict[int, bytes] = {0: ROOT}
    for i in (0, len(paths) - 1):
        state_of, key = 0, ROOT
        shared[0] = True
        for j in range(length[i]):
            state_of = trie.base[state_of] + codes[start[i] + j]
            key = _chain(key, paths[i][j * NAME : (j + 1) * NAME])
            shared[trie.node[state_of]] = True
            keys[int(trie.node[state_of])] = key

    inner = ~shared
    children = np.bincount(nodes.parent[1:][inner[1:]], minlength=n)
    leaves = (inner & (children == 0)).astype(np.int64)
    saved = np.where(inner, (convs - 1) * size, 0)
    for level in range(int(nodes.depth.max()), 0, -1):
        at = np.flatnonzero((nodes.depth == level) & inner)
        np.add.at(leaves, nodes.parent[at], leaves[at])
        np.add.at(saved, nodes.parent[at], saved[at])

    parent = nodes.parent.copy()
    parent[0] = 0
    known = inner & inner[parent]
    end_of: list[str | None] = [None] * n
    for node, digest in zip(nodes.last.tolist(), ends, strict=True):
        end_of[node] = digest
    up = [
        keys[p] if k and shared[p] else None
        for k, p in enumerate(parent.tolist())
    ]
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array([keys.get(k) for k in range(n)], pa.binary()),
            "up": pa.array(up, pa.binary()),
            "conv_id": pa.array(smallest),
            "depth": pa.array(nodes.depth, pa.int64()),
            "parent_conv_id": pa.array(smallest[parent], mask=~known),
            "n_convs": pa.array(convs),
            "n_children": pa.array(children, pa.int64()),
            "n_leaves": pa.array(leaves),
            "saved_tokens": pa.array(saved),
            "chars": pa.array(size),
            "ends_sha256": pa.array(end_of, pa.string()),
        }
    )


def _parts(pieces: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        turns = 0
        for sequence in _sequences(batches):
            block.append(sequence)
            turns += 1 + len(sequence[0]) // NAME
            if turns >= BLOCK:
                yield _block(block)
                block, turns = [], 0
        if block:
            yield _block(block)

    ordered = pieces.repartitionByRange("path").sortWithinPartitions("path", "piece")
    return ordered.mapInArrow(run, _PARTS)


def _shared_totals(shared: DataFrame) -> DataFrame:
    """The nodes of several blocks: parts summed, totals over subtrees."""
    merged = shared.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("up", "depth", "chars")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
    )
    merged = staged(merged, "shared-nodes")
    below = merged.groupBy(F.col("up").alias("_up")).agg(F.count("*").alias("_more"))
    own = merged.join(below, F.col("key") == F.col("_up"), "left").drop("_up")
    children = F.col("n_children") + F.coalesce("_more", F.lit(0))
    now = staged(
        own.withColumns(
            {
                "n_children": children,
                "n_leaves": F.col("n_leaves") + (children == 0).cast("bigint"),
                "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"),
                "far": F.col("up"),
            }
        ).drop("_more"),
        "shared-nodes",
    )
    deepest = now.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        gathered = now.filter("far IS NOT NULL").groupBy(F.col("far").alias("_key")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")
        )
        next_up = now.select(F.col("key").alias("_at"), F.col("far").alias("_far"))
        now = staged(
            now.join(gathered, F.col("key") == F.col("_key"), "left")
            .join(next_up, F.col("far") == F.col("_at"), "left")
            .withColumns(
                {
                    "n_leaves": F.col("n_leaves") + F.coalesce("_leaves", F.lit(0)),
                    "saved_tokens": F.col("saved_tokens") + F.coalesce("_saved", F.lit(0)),
                    "far": F.col("_far"),
                }
            )
            .drop("_key", "_leaves", "_saved", "_at", "_far"),
            "shared-nodes",
        )
    return now


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: ``conv_id``, ``depth``, ``parent_conv_id``, counts and ``ends_sha256``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored.
    """
    ship(turns.sparkSession)
    parts = staged(_parts(staged(_pieces(rebuilt(turns)), "paths")), "trie-parts")
    shared = _shared_totals(parts.filter("key IS NOT NULL"))
    whole = parts.filter("key IS NULL").select(*parts.columns).unionByName(
        shared.select(*parts.drop("parent_conv_id").columns, F.lit(None).cast("bigint").alias("parent_conv_id"))
    )
    above = shared.select(F.col("key").alias("_above"), F.col("conv_id").alias("_conv_id"))
    return whole.join(above, F.col("up") == F.col("_above"), "left").select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "_conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"),
    )
