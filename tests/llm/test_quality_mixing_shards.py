from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faregrid.llm import mixing, quality, shards
from faregrid.llm.words import word_count

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_equal_plain_counts(edge_docs, no_docs):
    texts = {}
    for r in edge_docs.collect():
        texts.setdefault(r["doc_id"], set()).add(plain_counts(r["text"]))
    got = quality.quality(edge_docs).collect()
    assert len(got) == edge_docs.count()
    for r in got:
        counts = tuple(
            r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        )
        assert counts in texts[r["doc_id"]]
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality.quality(no_docs).count() == 0


def test_rules_are_compiled_from_the_table(spark):
    good = "The house of the old man is on a hill and it was built for the war. " * 4
    texts = [" ".join(f"{w}{i}" for i, w in enumerate(good.split())), "# " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    strict = (quality.Rule("any_symbol", "n_symbols / n_words", None, 0.0),)
    verdicts = [r["kept"] for r in quality.quality(docs, strict).orderBy("doc_id").collect()]
    assert verdicts == [True, False]


def test_keep_good_keeps_columns(edge_docs, no_docs):
    assert quality.keep_good(edge_docs).schema == edge_docs.schema
    assert quality.keep_good(no_docs).count() == 0


def test_quality_plan_is_one_projection(spark, plan_text):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_text(quality.quality(docs))
    assert not re.search("Exchange|Python|Arrow|Join|Window", plan)


@pytest.mark.parametrize("count", [1, 2, 3, 40, 41, 1000, 4097])
def test_permutation(count):
    numbers = np.arange(count)
    out = shards.permute(numbers, count)
    assert sorted(out.tolist()) == numbers.tolist()
    assert shards.permute(out, count, back=True).tolist() == numbers.tolist()
    for number in (0, count - 1):
        shard, slot = shards.place(number, count, 7)
        assert slot * 7 + shard == out[number]
        assert shards.row_at(shard, slot, count, 7) == number


def test_shards(edge_docs, no_docs):
    got = shards.sharded(edge_docs, 4).collect()
    rows = edge_docs.collect()
    assert len(got) == len(rows)
    want = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
        for r in rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(4)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert shards.sharded(no_docs, 4).count() == 0
    again = shards.sharded(edge_docs.repartition(5), 4).collect()
    alike = lambda rows: Counter((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in rows)
    assert alike(again) == alike(got)


def water(sizes):
    """Targets by sharing the excess again and again."""
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target = dict.fromkeys(sizes, 0.0)
    open_, left = set(sizes), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / total for s in open_}
        left = 0.0
        for s, x in share.items():
            cap = 3 * sizes[s]
            left += max(0.0, target[s] + x - cap)
            target[s] = min(cap, target[s] + x)
        open_ = {s for s in open_ if target[s] < 3 * sizes[s]}
    return target


def mix_fixture(spark):
    rows, n = [], 0
    for source, docs, words in ((None, 40, 30), ("a", 300, 200), ("b", 5, 10), ("c", 60, 120), ("é", 3, 0)):
        for _ in range(docs):
            rows.append((n, " ".join(f"w{n}" for _ in range(words + n % 3 * (words > 0))), source))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_its_targets(spark):
    docs = mix_fixture(spark)
    got = mixing.taken(docs).collect()
    sizes = Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
    want = water(sizes)
    for source, size in sizes.items():
        own = [r for r in got if r["source"] == source]
        assert {r["source_size"] for r in own} == {size}
        assert all(abs(r["target"] - want[source]) < 1e-6 * max(1, size) for r in own)
        assert abs(sum(r["taken"] for r in own) - want[source]) <= 0.02 * want[source] + 2 * mixing.BLOCK
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own)
    assert {(r["doc_id"], r["taken"]) for r in got} == {
        (r["doc_id"], r["taken"]) for r in mixing.taken(docs.repartition(7)).collect()
    }


def test_slots_and_blocks_are_joined_by_rank(spark):
    docs = mix_fixture(spark)
    got = mixing.taken(docs).collect()
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    slots = mixing.schedule(spark, mixing.source_targets(sizes)).orderBy("slot").collect()
    for source in {r["source"] for r in got}:
        own = sorted((r for r in got if r["source"] == source and r["size"]), key=lambda r: r["place"])
        line = [r["doc_id"] for r in own for _ in range(r["size"])] * mixing.MOST_EPOCHS
        words, first = Counter(), {}
        for rank, slot in enumerate(r["slot"] for r in slots if r["source"] == source):
            for doc in line[rank * mixing.BLOCK : (rank + 1) * mixing.BLOCK]:
                words[doc] += 1
                first.setdefault(doc, slot)
        assert {r["doc_id"]: (r["taken"], r["first_slot"]) for r in own} == {
            r["doc_id"]: (words[r["doc_id"]], first.get(r["doc_id"])) for r in own
        }


def test_ranks_go_on_from_range_to_range(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 7)
    monkeypatch.setattr(mixing, "WIDE", 3)
    sizes = spark.createDataFrame([("a", 900), ("b", 500), (None, 400)], "source string, source_size long")
    slots = mixing.schedule(spark, mixing.source_targets(sizes), 4)
    ranked = mixing.ranked_slots(slots, mixing.range_counts(slots)).collect()
    for number in (0, 1, 2):
        own = sorted((r["block"], r["slot"]) for r in ranked if r["number"] == number)
        assert [b for b, _ in own] == list(range(len(own))) and len(own) > 50
        assert [s for _, s in own] == sorted(s for _, s in own)


def test_mixed_rows_hold_the_words_taken(spark):
    docs = mix_fixture(spark)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(docs).collect()}
    words = Counter()
    for r in mixing.mixed(docs).collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert {k: v for k, v in taken.items() if v} == dict(words)


def test_mix_edge_rows(edge_docs, no_docs):
    got = mixing.taken(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mixed(edge_docs).schema.names == edge_docs.columns
    assert mixing.taken(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_schedule_gives_each_source_its_share_of_any_prefix(spark):
    sizes = spark.createDataFrame([("a", 5000), ("b", 5000), ("c", 5000)], "source string, source_size long")
    slots = mixing.schedule(spark, mixing.source_targets(sizes), 10).orderBy("slot").collect()
    for n in (60, 300, 1500):
        share = Counter(r["source"] for r in slots[:n])
        assert all(abs(share[s] - n * w / 6) <= 6 for s, w in (("a", 1), ("b", 2), ("c", 3)))
