"""Drops taken in one by one equal a full run; a drop sent again adds nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faregrid.operators import quality
from faregrid.plans import gold, increments, onepass, silver, summary
from faregrid.plans.jobs import Lake
from workload import adapters

SMALL = "/root/testdata/sf0.001"


def fact_of(kept):
    missing = F.lit(None).cast("double")
    names = ("weather_temp_c", "weather_wind_kmh", "weather_precip_mm")
    return gold.metered_fact(kept.withColumns(dict.fromkeys(names, missing)))


@pytest.fixture(scope="module")
def drops(spark):
    every = adapters.metered_redelivered(spark, SMALL)
    once = adapters.metered_bronze(spark, SMALL)
    again = every.exceptAll(once)
    return {"a": once.filter("puYear < 1997"), "b": once.filter("puYear >= 1997"), "c": again}, every


def taken(spark, root, order):
    store = increments.DropStore(Lake(str(root)), onepass.METERED, buckets=8)
    return store, [increments.absorb(spark, store, name, rows, fact_of) for name, rows in order]


def rows_of(df, *names):
    return sorted(map(str, df.select(*names).collect()))


def test_summaries_equal_a_full_run(spark, drops, tmp_path):
    parts, every = drops
    store, counts = taken(spark, tmp_path, parts.items())
    full = silver.metered_silver(every)
    kept = increments.all_drops(spark, store, "kept")
    assert rows_of(kept, *full.kept.columns) == rows_of(full.kept, *full.kept.columns)
    assert sum(c["kept"] for c in counts) == full.kept.count()
    failed = increments.all_drops(spark, store, "failed")
    assert failed.count() == quality.failed(every, quality.METERED_RULES).count()
    cells = increments.all_drops(spark, store, "cells")
    fact = fact_of(full.kept)
    for have, want in (
        (summary.monthly_metered(summary.cells_of(cells, "clock"), tallied=True), summary.monthly_metered(fact)),
        (summary.hourly_summary(summary.cells_of(cells, "clock"), tallied=True), summary.hourly_summary(fact)),
    ):
        assert rows_of(have, *want.columns) == rows_of(want, *want.columns)


def test_a_drop_sent_again_adds_nothing(spark, drops, tmp_path):
    parts, _ = drops
    store, counts = taken(spark, tmp_path, [("a", parts["a"]), ("again", parts["a"]), ("a", parts["a"])])
    assert counts[0]["kept"] > 0 and counts[1]["kept"] == 0 and counts[2] == counts[0]
    assert increments.all_drops(spark, store, "kept").count() == counts[0]["kept"]
    keys = spark.table(store.keys_table(spark))
    assert keys.count() == counts[0]["kept"] == keys.select("key_text").distinct().count()


def test_keys_outlive_the_session_entry(spark, drops, tmp_path):
    parts, _ = drops
    store, counts = taken(spark, tmp_path, [("a", parts["a"])])
    spark.sql(f"DROP TABLE {store.keys_table(spark)}")  # the files stay, as for a new session
    assert spark.table(store.keys_table(spark)).count() == counts[0]["kept"]
    assert increments.absorb(spark, store, "again", parts["a"], fact_of)["kept"] == 0


def test_only_the_new_drop_is_shuffled(spark, drops, tmp_path, plan_text):
    parts, _ = drops
    store, _ = taken(spark, tmp_path, [("a", parts["a"])])
    known = spark.table(store.keys_table(spark)).select("key_text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(increments.unknown(parts["b"], known, list(onepass.METERED.keys)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.split("\n\n")[0].count("Exchange") == 1
    assert "SelectedBucketsCount: 8 out of 8" in text


def test_null_keys_and_separators_are_told_apart(spark):
    rows = spark.createDataFrame(
        [(None, "a"), ("", "a"), ("-", "a"), ("=", None), ('","=a', "x"), ("a", '","=x')], "p string, q string"
    )
    assert rows.select(increments.key_text(["p", "q"])).distinct().count() == rows.count()


def test_empty_drop(spark, drops, tmp_path):
    parts, _ = drops
    store, counts = taken(spark, tmp_path, [("none", parts["a"].filter("false")), ("a", parts["a"])])
    assert counts[0]["kept"] == counts[0]["failed"] == 0 < counts[1]["kept"]
