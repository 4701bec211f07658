from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from faregrid.llm import simhash
from faregrid.llm.components import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {ord(c): " " for c in "\t\n\x0b\x0c\r"}
    ).split(" ")
    words = [w for w in words if w]
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(ids))]


def test_code_covers_every_value_once():
    syndrome, patterns = simhash.golay()
    assert len(syndrome) == 1 << 23 and len(patterns) == 2048
    weights = [np.bitwise_count(p.astype(np.uint32)) for p in patterns]
    assert all(w[0] <= 3 < w[1] for w in weights if len(w) > 1)
    assert sum((w <= 3).sum() for w in weights) == 2048


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4])
def test_near_fingerprints_share_an_anchor(bits):
    rng = random.Random(bits)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for place in rng.sample(range(64), bits):
            b ^= 1 << place
        rows, keys = simhash.anchors(np.asarray([a, b], dtype=np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_fingerprints_and_components_equal_plain_ones(spark, edge_docs, no_docs):
    rows = edge_docs.collect()
    ids, fps = [r["doc_id"] for r in rows], [plain_fingerprint(r["text"]) for r in rows]
    got = simhash.near_duplicates(edge_docs).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(
        ((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=key
    ) == sorted(zip(ids, fps, plain_components(ids, fps), strict=True), key=key)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_documents_of_the_smallest_scale(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    ids, fps = [r["doc_id"] for r in rows], [plain_fingerprint(r["text"]) for r in rows]
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == dict(zip(ids, zip(fps, plain_components(ids, fps), strict=True), strict=True))


def test_dense_and_chained_fingerprints(spark):
    rng = random.Random(5)
    fps = []
    for _ in range(3):  # balls with hundreds of neighbours, and chains of steps of four bits
        centre = rng.getrandbits(64)
        for _ in range(250):
            fps.append(centre ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 4))))
        at = centre
        for _ in range(30):
            at ^= sum(1 << p for p in rng.sample(range(64), 4))
            fps.append(at)
    fps = list(dict.fromkeys(fps))
    signed = [(f - 2**64 if f >> 63 else f,) * 2 for f in fps]
    nodes = spark.createDataFrame(signed, "node long, fp long").repartition(3)
    found = {r["node"] % 2**64: r["component"] for r in components(simhash.links(nodes)).collect()}
    want = plain_components(list(range(len(fps))), fps)
    groups = {}
    for fp, component in zip(fps, want, strict=True):
        groups.setdefault(component, set()).add(found.get(fp, ("alone", fp)))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set().union(*groups.values())) == len(groups)


def test_one_of_each(edge_docs, no_docs):
    kept = simhash.one_of_each(edge_docs)
    assert kept.schema == edge_docs.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) == 1 and 8 in ids and 9 not in ids and ids.count(None) == 2
    assert simhash.one_of_each(no_docs).count() == 0


def test_components_of_a_star_and_a_path(spark):
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 160)] + [(5, 5)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(60)} | {
        i: 100 for i in range(100, 161)
    }


def test_edges_that_are_stars_need_no_round(spark):
    from faregrid.session import scratch_paths

    before = set(scratch_paths(spark))
    edges = spark.createDataFrame([(1, n) for n in range(2, 30)] + [(40, 31), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {n: 1 for n in range(1, 30)} | {31: 31, 40: 31}
    made = [p.rsplit("/", 1)[1] for p in scratch_paths(spark) if p not in before]
    assert not [p for p in made if p.startswith("stars-")]


@pytest.mark.parametrize("later", [0, 1, 25])
def test_grown_components_equal_those_of_all_edges(spark, later):
    from faregrid.llm.components import grown

    rng = random.Random(later)
    pairs = [(rng.randrange(90), rng.randrange(90)) for _ in range(40 + later)]
    first, rest = (spark.createDataFrame(p or [], "a long, b long") for p in (pairs[:40], pairs[40:]))
    got = grown(components(first), rest).collect()
    want = components(first.union(rest)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
