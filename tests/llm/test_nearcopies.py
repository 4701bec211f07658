"""Stage 2 of the pipeline against brute force over all pairs."""

from __future__ import annotations

import random

import pytest

from faregrid.llm import nearcopies, simhash
from faregrid.llm.components import components
from faregrid.session import scratch_paths


def plain_set(text):
    found = [w for w in (text or "").lower().split() if w]
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return set(zip(*[found[i:] for i in range(5)], strict=False))


def plain_groups(rows):
    """Smallest id of the group of each row; rows are pairs of id and text."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            common, every = len(x & sets[j]), len(x | sets[j])
            if 5 * common >= 4 * every:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {doc_id: least[find(i)] for i, (doc_id, _) in enumerate(rows)}


def made_texts():
    rng = random.Random(4)
    word = lambda: f"w{rng.randint(0, 3000)}"
    passage = [word() for _ in range(60)]
    out = [None, "", "one two", "ONE two", "a b c d e"]
    for size in (6, 20, 60, 300):
        for _ in range(6):
            base = [word() for _ in range(size)]
            for _ in range(8):  # edits on both sides of 0.8
                copy = list(base)
                for _ in range(rng.randint(0, max(1, size // 25))):
                    copy[rng.randrange(size)] = word()
                out.append(" ".join(copy))
                base = copy if rng.random() < 0.3 else base  # chains
    for _ in range(40):  # a common passage in otherwise different texts, more or less of it
        own = [word() for _ in range(rng.randint(1, 60))]
        out.append(" ".join(passage + own))
    rng.shuffle(out)
    return list(enumerate(out))


def test_groups_of_made_texts_equal_brute_force(spark):
    rows = made_texts()
    want = plain_groups(rows)
    assert 5 < len(set(want.values())) < len(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(docs).collect()}
    assert got == want
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect())
    assert kept == sorted(set(want.values()))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_groups_of_the_documents_equal_brute_force(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet").select("doc_id", "text")
    want = plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect())
    assert kept == sorted(set(want.values()))


def test_fingerprints_that_meet_at_an_anchor_are_proposed_first(spark):
    rows = made_texts()
    rows = [*rows, *[(5000 + i, f"{t} tail") for i, t in rows if t and len(t.split()) > 200]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {nearcopies._node(s): s for _, t in rows if len(s := nearcopies.shingles(t))}
    fps = {n: nearcopies._fingerprint(s) for n, s in sets.items()}
    close = {(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= simhash.DISTANCE}
    nodes = spark.createDataFrame([(n, len(sets[n]), fp) for n, fp in fps.items()], "node long, size long, fp long")
    pairs = {(r["a"], r["b"]) for r in nearcopies._anchored(nodes).collect()}
    assert pairs and pairs <= close
    labels = {r["node"]: r["component"] for r in components(nearcopies._anchored(nodes)).collect()}
    assert all(labels[a] == labels[b] for a, b in close)
    before = set(scratch_paths(spark))
    nearcopies.near_copies(docs)
    steps = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in scratch_paths(spark) if p not in before]
    assert steps.index("anchor-pairs") < steps.index("star-pairs")


def kept_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, size int")
    return sorted(((r["doc_id"], r["text"]) for r in simhash.one_of_each(docs.repartition(3)).collect()), key=str)


def test_ids_shared_by_texts_and_missing_ids(spark):
    one, other, third = "a b c d e f g h", "other words of another text here", "once more something else is said"
    rows = [(1, one), (2, one), (2, other), (1, one), (None, one), (None, third), (None, third), (4, None), (5, "")]
    want = [(1, one), (2, other), (None, one), (None, third), (4, None)]
    assert kept_rows(spark, [(*r, "x", 7) for r in rows]) == sorted(want, key=str)
    assert kept_rows(spark, []) == []


def test_one_id_for_two_texts_of_one_group(spark):
    words = [f"w{i}" for i in range(80)]
    near = " ".join([*words, "end"])
    rows = [(3, " ".join(words)), (3, near), (8, near + " more")]
    assert len(kept_rows(spark, [(*r, "x", 7) for r in rows])) == 1


def test_a_shingle_that_very_many_texts_hold(spark):
    """A common passage in otherwise different texts, beside a chain of true copies."""
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, passage + " " + " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(40))) for i in range(300)]
    rows += [(1000 + i, rows[7][1] + f" tail{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in nearcopies.near_copies(docs).collect()}
    assert got == plain_groups(rows)
