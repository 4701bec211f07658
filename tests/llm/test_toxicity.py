"""The label model on votes with known errors, the classifier on rows it has not seen."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faregrid.llm import toxicity
from faregrid.llm.toxicity import ABSTAIN, CLEAN, TOXIC

SMALL = "/root/testdata/sf0.1"


def drawn(n: int, share: float, seed: int, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """Votes of five voters of known accuracy; the last is repeated ``copies`` times."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < share
    votes = []
    for right, speaks in ((0.9, 0.8), (0.85, 0.7), (0.8, 0.9), (0.75, 0.6), (0.6, 0.9)):
        says = np.where(rng.random(n) < right, y, ~y)
        votes.append(np.where(rng.random(n) < speaks, np.where(says, TOXIC, CLEAN), ABSTAIN))
    return y, np.stack(votes + votes[-1:] * copies, axis=1)


def test_label_model_finds_share_and_accuracies_without_labels():
    y, votes = drawn(20_000, 0.35, 1, 0)
    model = toxicity.label_model(votes)
    assert abs(model.share - 0.35) < 0.04
    assert np.abs(model.accuracy - [0.9, 0.85, 0.8, 0.75, 0.6]).max() < 0.04
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.9


def test_repeated_votes_are_one_factor_and_count_once():
    y, votes = drawn(20_000, 0.35, 2, 2)
    model = toxicity.label_model(votes)
    assert (4, 5, 6) in model.factors
    assert model.correlation[4, 5] > 0.9
    _, alone = drawn(20_000, 0.35, 2, 0)
    right = [((m.posterior(v) > 0.5) == y).mean() for m, v in (
        (model, votes), (toxicity.label_model(alone), alone))]
    assert right[0] > right[1] - 0.01


def made(n: int) -> list[tuple]:
    draw = random.Random(4)
    plain = ["".join(draw.choices("abcdefghijkl", k=draw.randrange(2, 9))) for _ in range(600)]
    rude = ["zorkel", "blimp", "ufnagel", "quarto", "vexing"]
    rows = []
    for i in range(n):
        words = draw.choices(plain, k=draw.randrange(20, 200))
        toxic = int(draw.random() < 0.25)
        for _ in range(draw.randrange(1, 5) * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(rude))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_rows_not_seen(spark):
    rows = made(1200)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = df.filter("doc_id % 5 != 0")
    model = toxicity.fit(df.drop("toxic"), seen.select("doc_id", "toxic"))
    found = {r["doc_id"]: r for r in toxicity.scores(df, model).collect()}
    held = [r for r in rows if r[0] % 5 == 0]
    right = [found[i]["predicted"] == toxic for i, _, toxic in held]
    assert np.mean(right) > 0.97
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in found.values())


def test_fit_and_scores_are_the_same_on_a_rerun(spark):
    df = spark.createDataFrame(made(400), "doc_id long, text string, toxic int")
    runs = [
        toxicity.scores(df, toxicity.fit(df.repartition(n), df)).orderBy("doc_id").collect() for n in (2, 5)
    ]
    assert runs[0] == runs[1]


def test_long_texts_are_read_whole(spark):
    df = spark.createDataFrame(made(600), "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df)
    long = "abc def " * 20_000
    texts = spark.createDataFrame([(1, long), (2, long + " zorkel blimp ufnagel quarto vexing")], "doc_id long, text string")
    low, high = (r["score"] for r in toxicity.scores(texts, model).orderBy("doc_id").collect())
    assert high > 0.5 > low


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(0, 1), (1, 0), (1, 1), (5, 1), (6, 0), (7, None), (None, 1), (99, 1), (8, 2)], "doc_id long, toxic int"
    )
    for docs in (edge_docs, no_docs):
        for given in (labels, labels.filter("false"), labels.filter("toxic = 1")):
            rows = toxicity.scores(docs, toxicity.fit(docs, given)).collect()
            assert len(rows) == docs.count()
            assert all(0 <= r["score"] <= 1 for r in rows)
    both = toxicity.sample_of(edge_docs, labels).collect()
    assert sorted((r["text"] or "")[:5] + str(r["toxic"]) for r in both).count("1") <= 1
    none = toxicity.scores(edge_docs, toxicity.fit(edge_docs, labels.filter("false")))
    assert none.agg(F.max("score")).first()[0] == 0.0


@pytest.mark.parametrize("text", [None, "", "12 34", "a b"])
def test_texts_without_terms(text):
    assert toxicity.terms(text) == set()
