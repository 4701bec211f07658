"""Corpus pipeline: quality rules, near-duplicates, personal data, source mix, token ids.

Every stage reads what its predecessor wrote, so a lost executor costs the tasks of one
stage at most, and the next stage sees the real size of its input. What a stage put into the
shared folder on its way is removed when the next one starts: by then its result is stored.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from faregrid.llm import bpe, mixing, pii, quality, simhash
from faregrid.session import clear_scratch, scratch_paths, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# scratch paths of the last stage of each application
_left: dict[str, list[str]] = {}


def tidy(stage: Stage) -> Stage:
    """``stage``, after the scratch of the stage before it is removed.

    Paths that ``docs`` still reads stay, so a chain that is not written in between works too.
    """

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        old = _left.pop(app, [])
        if old:
            read = docs.inputFiles()
            used = [p for p in old if any(p.rsplit("/", 1)[1] in f for f in read)]
            clear_scratch(spark, set(old) - set(used))
            old = used
        before = set(scratch_paths(spark))
        result = stage(spark, docs, sf_dir)
        _left[app] = old + [p for p in scratch_paths(spark) if p not in before]
        return result

    return run


ORACLE_SQL = None  # fingerprints, trained spans and token ids are not SQL


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their counts and digests, decoded again to check them."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality rules", tidy(keep_good)),
    ("near-duplicates", tidy(drop_near_copies)),
    ("personal data", tidy(redact)),
    ("source mix", tidy(mix_sources)),
    ("token ids", tidy(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
