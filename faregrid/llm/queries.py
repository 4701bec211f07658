"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.llm import (
    bpe,
    forest,
    huffman,
    langid,
    maintext,
    mixing,
    phrases,
    pii,
    quality,
    shards,
    simhash,
    toxicity,
    turntrie,
)
from faregrid.llm.oracles import ORACLES  # noqa: F401  (registered beside the queries)

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn(
        "held_out", langid.crc_fold(F.col("doc_id")) == 0
    )
    model = langid.fit(docs.filter(~F.col("held_out")))
    return langid.predict(docs, model).select(
        "doc_id",
        (langid.crc_fold(F.col("doc_id")) == 0).alias("held_out"),
        "lang_pred",
        "score",
        "accepted",
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op3_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return forest.nearest(rows, F.col("id") % 100 == 0)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_decode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op5_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return huffman.stored_tokens(documents(spark, sf_dir), path)


def op6_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(documents(spark, sf_dir), SHARDS)


def op7_dom_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot"
    )


def op11_phrase_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op12_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.filter(langid.crc_fold(F.col("doc_id")) != 0))
    return toxicity.scores(docs, model).select(
        "doc_id",
        (langid.crc_fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        "predicted",
    )


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_centroid_language,
        op2_quality_rules,
        op3_projection_forest,
        op4_byte_bpe,
        op5_huffman_ids,
        op6_feistel_shards,
        op7_dom_trees,
        op8_simhash_anchors,
        op9_boosted_spans,
        op10_source_mix,
        op11_phrase_tries,
        op12_weak_toxicity,
        op13_turn_trie,
    )
}
