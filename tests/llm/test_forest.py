from __future__ import annotations

import math

import numpy as np
import pytest

from faregrid.llm import forest

QUERY = "id % 10 = 0"


def plain(rows, k=10):
    good = [
        (i, np.asarray(v, dtype=float))
        for i, v in rows
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)
    ]
    out = {}
    for q, x in good:
        if q % 10 == 0:
            near = sorted({(float(np.sqrt(((x - v) ** 2).sum())), i) for i, v in good if i != q})[:k]
            out[q] = [(rank + 1, i, pytest.approx(d, abs=1e-12)) for rank, (d, i) in enumerate(near)]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


SCHEMA = "vec_id long, embedding array<float>, score string, rank string, shard string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_edge_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (10, [0.0, 2.0]), (3, [0.0, 1.0])]
    rows += [(4, None), (5, []), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0])]
    rows += [(9, [None, 1.0]), (20, [0.0, 0.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0])]
    got = found(forest.nearest(table(spark, rows), QUERY))
    assert got == plain([*rows[:-1]])
    assert forest.nearest(table(spark, rows).filter("false"), QUERY).count() == 0
    # the most frequent length takes part, the smaller of two as frequent
    mixed = [(0, [1.0]), (1, [2.0]), (2, [1.0, 2.0]), (3, [1.0, 3.0])]
    assert found(forest.nearest(table(spark, mixed), QUERY)) == {0: [(1, 1, 1.0)]}


def test_whole_read_equals_brute_force_over_shards(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 8)).round(2)
    rows = [(i, base[i % 300 if i % 7 else 3].tolist()) for i in range(900)]  # a frequent vector
    got = found(forest.nearest(table(spark, rows), QUERY, share=1.0, shard_rows=64))
    flat = [(i, np.float32(v).tolist()) for i, v in rows]
    assert got == plain(flat)


def test_every_shard_has_a_task_of_its_own(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(512, 4)))]
    df = forest.nearest(table(spark, rows), QUERY, shard_rows=64)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shard" not in plan and "REPARTITION_BY_NUM" in plan
    got = found(df)
    assert set(got) == set(range(0, 512, 10)) and all(len(near) == 10 for near in got.values())


def test_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pairs = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    got = found(forest.nearest(rows, QUERY, shard_rows=256))
    want = plain(pairs)
    hit = [i in {j for _, j, _ in got[q]} for q, near in want.items() for _, i, _ in near]
    assert np.mean(hit) >= 0.9


def test_search_stops_early_on_clusters():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 50
    vectors = np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 16)) * 0.01
    reads = []
    searcher = forest.Forest(vectors)
    plain_rank = searcher._rank
    searcher._rank = lambda *a: reads.append(len(np.concatenate(a[1]))) or plain_rank(*a)
    (rows, near), = searcher.search(vectors[:1], 10)
    gap = np.sqrt(((vectors - vectors[0]) ** 2).sum(axis=1))
    assert np.allclose(near, np.sort(gap)[:10])
