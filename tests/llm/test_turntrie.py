"""The conversation trie against a plain version, its double arrays against dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from faregrid.llm import queries, turntrie
from faregrid.llm.doublearray import dense, nodes_of, pack

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("depth", T.StringType()),  # a clashing name
    ]
)


def plain(rows) -> list[tuple]:
    convs: dict[int, list] = {}
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(conv_id, []).append(((turn is not None, turn or 0), role, name, text))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members: dict[tuple, list[int]] = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids: dict[tuple, list[tuple]] = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def total(node):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [total(k) for k in kids.get(node, [])]
        return sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)

    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(built[c]) == len(node))
        leaves, saved = total(node)
        out.append(
            (
                min(of), len(node), min(members[node[:-1]]) if node else None, len(of),
                len(kids.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def have(spark, rows) -> list[tuple]:
    df = spark.createDataFrame([(*r, "other")[:5] for r in rows], SCHEMA)
    return sorted((tuple(r) for r in turntrie.prefix_trie(df.repartition(3)).collect()), key=str)


def made(n: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        same = draw.random() < 0.3  # a third are one and the same
        for t in range(4 if same else draw.randrange(9)):
            rows.append((c, t, "user" if t % 2 else "assistant", f"t{t}" if same else f"{draw.randrange(3)}é" * t))
    return rows


@pytest.mark.parametrize("block", [1, 40, turntrie.BLOCK])
def test_equals_the_plain_version_whatever_the_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(turntrie, "BLOCK", block)
    monkeypatch.setattr(turntrie, "PIECE", 16)
    rows = made(260, 3)
    assert have(spark, rows) == plain(rows)


def test_edge_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 2, "", "user"),
        (None, 0, "user", "lost"), (7, 0, None, ""), (7, None, "x", None), (100, 5, "u", "long " * 9000),
        (-3, 0, "u", "below"), (205, 0, "u", "no first"), (-100, 0, "u", "first of the negative"),
        *[(3, t, "u", str(t)) for t in range(300)],
    ]
    assert have(spark, rows) == plain(rows)
    assert have(spark, []) == []
    assert have(spark, [(None, 0, "u", "x")]) == []


def test_query_equals_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    found = queries.op13_turn_trie(spark, sf)
    assert dict(found.dtypes) == {
        **dict.fromkeys(found.columns, "bigint"), "ends_sha256": "string",
    }
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=5), min_size=1, max_size=40))
def test_double_array_holds_exactly_its_sequences(sequences):
    sequences.sort()
    flat = np.asarray([x for s in sequences for x in s], dtype=np.int64)
    codes, most = dense(flat)
    start = np.r_[0, np.cumsum([len(s) for s in sequences])].astype(np.int64)
    nodes = nodes_of(codes, start)
    trie = pack(nodes, most)
    prefixes = {tuple(s[:d]) for s in sequences for d in range(len(s) + 1)}
    assert len(nodes.parent) == len(prefixes)
    assert len(set(trie.place.tolist())) == len(prefixes)
    code_of = dict(zip(flat.tolist(), codes.tolist(), strict=True))
    for p in prefixes:
        state = np.zeros(1, dtype=np.int64)
        for x in p:
            state = trie.step(state, np.asarray([code_of[x]]))
            assert state[0] >= 0
        for x in range(8):
            there = trie.step(state, np.asarray([code_of.get(x, 0)]))[0] >= 0
            assert there == ((*p, x) in prefixes)
