"""Approximate nearest neighbours with forests of random-projection trees.

Rows are dealt by a hash of their vector into shards of about ``ROWS`` vectors. The
task of a shard grows ``TREES`` trees over all its vectors, each node splitting at the
median of a random projection, and answers every query with one priority queue for all
its trees: the side a query falls on keeps the margin of its parent, the other side
waits with its distance to the plane. Leaves are read in that order until no waiting
leaf can hold a nearer vector, or ``SHARE`` of the shard has been read; what was read is
ranked by exact distance in double precision.

Equal vectors are one row with their ``K + 1`` smallest ids, found by a group limit
that drops the rest in the map tasks; any answer needs at most those.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers
take no part, nor do vectors that have not the most frequent length (the smaller of
two as frequent); rows with a null id take no part; rows repeated with the same id and
vector count once; with fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm.ship import ship
from faregrid.session import staged

K = 10
TREES = 16
LEAF = 32
SHARE = 0.5
ROWS = 16_384
SEED = 7


@dataclass
class Tree:
    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray  # of node i at [i]; ~leaf for leaves
    leaves: list[np.ndarray]


def grow(vectors: np.ndarray, rng: np.random.Generator, leaf: int = LEAF) -> Tree:
    """Split at the median of a random projection until at most ``leaf`` vectors are left."""
    normals, offsets, children, leaves = [], [], [], []

    def add(rows: np.ndarray) -> tuple[int, list]:
        if len(rows) > leaf:
            normal = rng.standard_normal(vectors.shape[1])
            normal /= np.linalg.norm(normal)
            along = vectors[rows] @ normal
            middle = np.median(along)
            low = along < middle
            if low.any():
                normals.append(normal)
                offsets.append(middle)
                children.append([0, 0])
                node = len(normals) - 1
                return node, [(node, 0, rows[low]), (node, 1, rows[~low])]
        leaves.append(rows)
        return ~(len(leaves) - 1), []

    root, todo = add(np.arange(len(vectors)))
    while todo:
        node, side, rows = todo.pop()
        children[node][side], more = add(rows)
        todo += more
    if root < 0:  # all in one leaf: a plane nobody is beyond
        normals, offsets, children = [np.zeros(vectors.shape[1])], [-1.0], [[root, root]]
    return Tree(np.asarray(normals), np.asarray(offsets), np.asarray(children), leaves)


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.vectors = vectors
        self.trees = [grow(vectors, rng, leaf) for _ in range(trees)]

    def search(self, queries: np.ndarray, k: int, share: float = SHARE):
        """Per query the rows read with the ``k`` smallest distances, and these."""
        margins = [t.normals @ queries.T - t.offsets[:, None] for t in self.trees]
        children = [t.children.tolist() for t in self.trees]
        most = share * len(self.vectors)
        for q, query in enumerate(queries):
            margin = [m[:, q].tolist() for m in margins]
            queue = [(0.0, t, 0) for t in range(len(self.trees))]
            read = np.zeros(len(self.vectors), dtype=bool)
            rows, near, count = np.zeros(0, dtype=np.int64), np.zeros(0), 0
            waiting: list[np.ndarray] = []
            while queue:
                far, t, node = heapq.heappop(queue)
                if len(near) >= k and far > near[k - 1]:
                    break  # no plane still to cross is as near as the k-th row
                if node < 0:
                    waiting.append(self.trees[t].leaves[~node])
                else:
                    side = margin[t][node]
                    low, high = children[t][node]
                    heapq.heappush(queue, (max(far, side), t, low))
                    heapq.heappush(queue, (max(far, -side), t, high))
                if len(waiting) == 32 or (waiting and not queue):
                    rows, near, count = self._rank(query, waiting, read, rows, near, count, k)
                    waiting = []
                    if count >= most and len(near) >= k:
                        break
            if waiting:
                rows, near, count = self._rank(query, waiting, read, rows, near, count, k)
            yield rows, near

    def _rank(self, query, waiting, read, rows, near, count, k):
        new = np.concatenate(waiting)
        new = np.unique(new[~read[new]])
        read[new] = True
        gap = self.vectors[new] - query
        near = np.concatenate([near, np.sqrt(np.einsum("ij,ij->i", gap, gap))])
        rows = np.concatenate([rows, new])
        best = np.lexsort((rows, near))[:k]
        return rows[best], near[best], count + len(new)


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part."""
    plain = rows.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).alias("vector")
    )
    # infinite numbers and NaN do not differ from themselves by zero
    finite = F.forall("vector", lambda x: x.isNotNull() & (x - x == 0.0))
    some = F.exists("vector", lambda x: x != 0.0)
    kept = plain.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & some)
    lengths = kept.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "size").first()
    return kept.filter(F.size("vector") == (common["size"] if common else 0))


def _grouped(rows: DataFrame, ids: int) -> DataFrame:
    """Distinct vectors with their ``ids`` smallest ids."""
    place = F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))
    # the group limit leaves few rows of a frequent vector to shuffle
    few = rows.withColumn("_place", place).filter(F.col("_place") <= ids)
    return few.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def nearest(
    rows: DataFrame,
    is_query,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    share: float = SHARE,
    shard_rows: int = ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows found.

    ``is_query`` is a condition on ``id``. Queries go to every shard as rows of its
    input, behind the vectors of the shard, and are answered batch by batch: a task
    holds one shard, that of its own number, never all queries, and nothing passes through
    the driver.
    """
    ship(rows.sparkSession)
    valid = usable(rows, id_column, vector_column)
    index = staged(_grouped(valid, k + 1), "vectors")
    shards = max(1, -(-index.count() // shard_rows))
    none = F.lit(None).cast("bigint")
    stored = index.select(
        F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
        none.alias("query_id"),
        "ids",
        "vector",
    )
    asked = valid.filter(is_query).distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.col("id").alias("query_id"),
        F.lit(None).cast("array<bigint>").alias("ids"),
        "vector",
    )
    dealt = (
        stored.unionByName(asked)
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", F.col("query_id").asc_nulls_first(), F.col("ids")[0])
    )
    found = dealt.mapInArrow(
        _answers(k, share), "query_id bigint, vec_id bigint, score double"
    )
    by_distance = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_distance))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _answers(k: int, share: float):
    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, vectors, ids, forest = None, [], [], None
        for batch in batches:
            places = batch.column("shard").to_numpy()
            asks = batch.column("query_id").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(
                np.r_[True, (places[1:] != places[:-1]) | (asks[1:] != asks[:-1]), True]
            )
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if places[lo] != shard:
                    shard, vectors, ids, forest = places[lo], [], [], None
                if not asks[lo]:
                    vectors.append(matrix(part.column("vector")))
                    ids += part.column("ids").to_pylist()
                elif vectors:
                    forest = forest or Forest(np.concatenate(vectors))
                    yield _answer(forest, ids, part, matrix(part.column("vector")), k, share)

    return run


def _answer(forest: Forest, ids: list, part: pa.RecordBatch, queries, k: int, share: float):
    out: list[tuple[int, int, float]] = []
    asked = part.column("query_id").to_pylist()
    for query_id, (rows, near) in zip(asked, forest.search(queries, k + 1, share), strict=True):
        hits = [
            (float(d), i)
            for row, d in zip(rows, near, strict=True)
            for i in ids[row]
            if i != query_id
        ]
        out += [(query_id, i, d) for d, i in sorted(hits)[:k]]
    columns = list(zip(*out, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], pa.int64()),
            pa.array(columns[1], pa.int64()),
            pa.array(columns[2], pa.float64()),
        ],
        ["query_id", "vec_id", "score"],
    )
