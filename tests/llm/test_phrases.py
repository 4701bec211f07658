"""Collocations against a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from faregrid.llm import phrases


def plain(rows, frequent: int, first: int = 2000) -> list[tuple]:
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f: dict[str, Counter] = {}
    n: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= frequent}
        inside = {q[i:j] for q, a in good.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1)
                  if j - i < len(q) and a >= counts[q[i:j]]}
        rows_of = []
        for p, a in good.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                rows_of.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows_of)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(n: int) -> list[tuple]:
    draw = random.Random(5)
    words = ["The", "a", "new", "York", "é", "city", "of", "漢", "light x", "it's"]
    rows = []
    for i in range(n):
        line = " ".join(draw.choice(words) for _ in range(draw.randrange(1, 60)))
        line = line.replace("new", "New York city", 1).replace("of", "of the,\tnew", 1).replace("a", "a!b", 1)
        rows.append((draw.choice(["en", "en", None, "de"]), line))
    return rows


@pytest.mark.parametrize("most", [phrases.TRIE, 40])
def test_equals_the_plain_count_whatever_the_passes(spark, monkeypatch, most):
    monkeypatch.setattr(phrases, "FREQUENT", 6)
    monkeypatch.setattr(phrases, "TRIE", most)
    rows = texts(150) + [("en", "one of two three four five six " * 40)]
    docs = spark.createDataFrame([(lang, t, 1) for lang, t in rows], "lang string, text string, phrase int")
    have = phrases.collocations(docs.repartition(3))
    assert [d for _, d in have.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(tuple(r) for r in have.collect()) == plain(rows, 6)


def test_only_the_first_of_each_language(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FREQUENT", 4)
    monkeypatch.setattr(phrases, "FIRST", 7)
    rows = texts(150)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == plain(rows, 4, 7)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """A candidate that passes by chance is counted for nothing, never dropped."""
    monkeypatch.setattr(phrases, "FREQUENT", 6)
    rows = texts(120)
    docs = spark.createDataFrame(rows, "lang string, text string")
    full = phrases._bitmap
    monkeypatch.setattr(phrases, "_bitmap", lambda frequent, k: full(frequent, k) | 255)
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == plain(rows, 6)


def test_edge_rows(spark, edge_docs, no_docs, monkeypatch):
    assert phrases.collocations(no_docs).collect() == []
    assert {r["phrase"] for r in phrases.collocations(edge_docs).collect()} >= {"alpha beta gamma delta alpha"}
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert sorted(tuple(r) for r in phrases.collocations(edge_docs).collect()) == plain(rows, 100)
