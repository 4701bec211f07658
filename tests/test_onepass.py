"""One-pass silver and the stream: counts, repeated batches, late rows."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from faregrid.operators import quality
from faregrid.plans import jobs, onepass, silver
from faregrid.plans.jobs import Lake
from faregrid.sources import counted, readers, sinks
from faregrid.streaming import silver as stream
from workload import adapters, inputs

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    adapters.metered_redelivered(spark, SMALL).write.parquet(lake.path("bronze/metered"))
    return lake


def same(a, b) -> None:
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    assert a.select(*names).exceptAll(b.select(*names)).isEmpty()
    assert b.select(*names).exceptAll(a.select(*names)).isEmpty()


def test_both_outcomes_equal_the_two_scan_form(spark, lake):
    counts = onepass.split_job(spark, lake, onepass.METERED)
    bronze = lake.read(spark, "bronze/metered")
    want = silver.metered_silver(bronze)
    have = onepass.branches(spark, lake.path("silver_split/metered"), quality.METERED_RULES)
    same(have.kept, want.kept)
    same(have.dead_letters, want.dead_letters)
    report = quality.report(bronze, quality.METERED_RULES).first().asDict()
    row = onepass.quality_report(spark, counts).first().asDict()
    assert {k: row[k] for k in report} == report
    assert row["removed_rows"] == report["passed_rows"] - want.kept.count() > 0


def test_unknown_verdicts_are_in_neither_branch(spark, lake):
    counts = onepass.split_job(spark, lake, onepass.METERED, quality.NULL_UNKNOWN)
    row = onepass.quality_report(spark, counts).first()
    assert row["undecided_rows"] > 0
    assert counts["failed_stored"] == counts["failed_rows"]


def test_bronze_is_scanned_once(spark, lake, plan_text):
    bronze = lake.read(spark, "bronze/metered")
    rows = onepass.outcomes(quality.with_flags(bronze, quality.METERED_RULES), onepass.METERED)
    text = plan_text(rows)
    assert text.split("\n\n")[0].count("Scan parquet") == 1
    assert "WindowGroupLimit" in text


def test_flags_and_features_are_not_shuffled(spark, lake, plan_text, monkeypatch):
    plans, write = [], onepass.sinks.replace_all

    def seen(df, *args, **options):
        plans.append(plan_text(df))
        write(df, *args, **options)

    monkeypatch.setattr(onepass.sinks, "replace_all", seen)
    onepass.split_job(spark, lake, onepass.METERED)
    moved = [part for part in plans[0].split("\n\n") if ") Exchange" in part]
    assert len(moved) == 2
    for part in moved:
        assert "valid_" not in part and "pickup_date_str" not in part and "pickup_dow" not in part


def test_empty_bronze(spark, lake, tmp_path):
    empty = Lake(str(tmp_path))
    lake.read(spark, "bronze/metered").filter("false").write.parquet(empty.path("bronze/metered"))
    counts = onepass.split_job(spark, empty, onepass.METERED)
    assert set(counts.values()) == {0}
    parts = onepass.branches(spark, empty.path("silver_split/metered"), quality.METERED_RULES)
    assert parts.kept.count() == parts.dead_letters.count() == 0


def test_counts_that_disagree_are_taken_again():
    assert counted.believed({"rows": 5, "x": 1}, {"rows": 5}, dict) == {"rows": 5, "x": 1}
    assert counted.believed({"rows": 9, "x": 2}, {"rows": 5}, lambda: {"rows": 5, "x": 1}) == {"rows": 5, "x": 1}


def test_enrichment_counts_come_from_its_write(spark, lake):
    onepass.split_job(spark, lake, onepass.METERED)
    hours = inputs.hourly(spark, SMALL)
    hours.write.mode("overwrite").parquet(lake.path("silver/weather"))
    counts = onepass.enrich_job(spark, lake)
    table = lake.read(spark, "silver/metered_enriched")
    assert counts == {"rows": table.count(), "matched": table.filter("weather_temp_c IS NOT NULL").count()}
    twice = Lake(lake.root)
    hours.union(hours).write.mode("overwrite").parquet(lake.path("silver/weather"))
    with pytest.raises(ValueError, match="weather join"):
        onepass.enrich_job(spark, twice)


def test_payloads_are_decoded_once_for_both_branches(spark, tmp_path, plan_text, monkeypatch):
    lake, plans, write = Lake(str(tmp_path)), [], sinks.replace_all

    def seen(df, *args, **options):
        plans.append(plan_text(df))
        write(df, *args, **options)

    inputs.envelope(spark, SMALL).write.parquet(lake.path("bronze/messages"))
    monkeypatch.setattr(sinks, "replace_all", seen)
    counts = jobs.stream_silver_job(spark, lake, str(tmp_path / "no-weather"))
    assert len(plans) == 3 and ["from_json" in p for p in plans].count(True) == 1
    want = silver.stream_silver(lake.read(spark, "bronze/messages"))
    stamps = ("ingestion_timestamp", "silver_timestamp", "failure_timestamp")
    stored = [lake.read(spark, name) for name in ("silver/messages", "dead_letter/messages")]
    for have, plain, rows in zip(stored, (want.kept, want.dead_letters), (counts["kept"], counts["dead_letters"]), strict=True):
        same(have.drop(*stamps), plain.drop(*stamps))
        assert have.count() == rows > 0


def landed(spark, folder, messages, **options):
    messages.write.mode("append").parquet(f"{folder}/landing")
    source = readers.message_folder_stream(spark, f"{folder}/landing")
    return stream.drain_silver(source, f"{folder}/silver", f"{folder}/counts", f"{folder}/state", **options)


def sent(spark) -> tuple:
    """Messages of the driver's trips, first those sent once, then those sent again."""
    every = adapters.messages(spark, SMALL)
    again = F.col("offset") >= 10_000_000_000
    return every.filter(~again), every.filter(again), inputs.envelope(spark, SMALL)


def test_stream_equals_the_batch_over_two_restarts(spark, tmp_path):
    once, again, envelope = sent(spark)
    half = F.col("offset") % 2 == 0
    gone = [landed(spark, tmp_path, part, delay="9000 days") for part in (once.filter(half), once.filter(~half), again)]
    want = silver.stream_silver(envelope)
    have = stream.stored_silver(spark, f"{tmp_path}/silver")
    dropped = ["ingestion_timestamp", "silver_timestamp", "failure_timestamp", "kafka_timestamp"]
    kept = have.kept.drop(*dropped)
    same(kept, want.kept.select(*kept.columns))
    same(have.dead_letters.drop(*dropped), want.dead_letters.drop(*dropped))
    assert sum(g["late"] for g in gone) == 0 and sum(g["repeated"] for g in gone) > 0
    counts = spark.read.parquet(f"{tmp_path}/counts").groupBy("outcome").agg(F.sum("rows")).collect()
    assert dict(map(tuple, counts)) == {"kept": have.kept.count(), "failed": have.dead_letters.count()}
    assert stream.missing(envelope, have).isEmpty()


HEAP_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.mark.parametrize("begun", [None, HEAP_STORE])
def test_state_of_the_stream_lies_on_disk(spark, tmp_path, begun):
    own = {key: spark.conf.get(key, None) for key in stream.STATE_SETTINGS}
    store = next(key for key in own if key.endswith("providerClass"))
    once, again, _ = sent(spark)
    if begun:
        spark.conf.set(store, begun)
    try:
        landed(spark, tmp_path, once, delay="9000 days")
    finally:
        if begun:
            spark.conf.unset(store)
    gone = landed(spark, tmp_path, again, delay="9000 days")
    kinds = {p.suffix for p in tmp_path.glob("state/state/0/*/*")}
    assert (".zip" in kinds) == (begun is None) and (".delta" in kinds) == (begun is not None)
    assert gone["repeated"] > 0
    assert {key: spark.conf.get(key, None) for key in own} == own


def on_disk(spark) -> dict[str, set[str]]:
    """Shuffle files and opened partitions of a state in the local folders of the session."""
    jvm = spark._jvm.org.apache.spark
    blocks = jvm.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    own = jvm.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())
    return {
        "shuffle": {str(p) for d in blocks for p in Path(d).rglob("shuffle_*")},
        "state": {str(p) for p in Path(own).glob("StateStoreId*")},
    }


def test_a_drained_stream_leaves_neither_shuffle_files_nor_state_on_the_executors(spark, tmp_path):
    once, again, _ = sent(spark)
    before = on_disk(spark)
    for part in (once, again):
        assert landed(spark, tmp_path, part, delay="9000 days")["late"] == 0
    left = {kind: found - before[kind] for kind, found in on_disk(spark).items()}
    assert left == {"shuffle": set(), "state": set()}
    assert {p.name.split(".", 1)[1] for p in tmp_path.rglob("silver/**/part-*")} == {"c000.zstd.parquet"}


def test_features_and_flags_are_no_part_of_the_shuffle_of_the_stream(spark, tmp_path):
    once, _, _ = sent(spark)
    once.write.parquet(f"{tmp_path}/landing")
    source = readers.message_folder_stream(spark, f"{tmp_path}/landing")
    query = stream.start_silver(source, *[f"{tmp_path}/{x}" for x in ("silver", "counts", "state")], drain=True)
    query.awaitTermination()
    nodes, moved = [query._jsq.streamingQuery().lastExecution().executedPlan()], set()
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange":
            moved |= set(node.schema().fieldNames())
    assert {"fare_amount", "kafka_offset", "kafka_timestamp"} < moved
    flags = {rule.flag for rule in quality.STREAM_RULES} | {"is_valid"}
    features = {"pickup_hour", "pickup_month", "pickup_year", "pickup_dow", "is_weekend", "is_rush_hour"}
    assert not moved & (flags | features | {"ingestion_timestamp", "silver_timestamp"})


def test_late_rows_are_counted_and_found(spark, tmp_path):
    once, _, envelope = sent(spark)
    newest = once.agg(F.max("timestamp")).first()[0]
    cut = newest - dt.timedelta(days=400)
    held = F.col("timestamp") < F.lit(cut)
    landed(spark, tmp_path, once.filter(~held), delay="1 day")
    gone = landed(spark, tmp_path, once.filter(held), delay="1 day")
    assert gone["late"] == once.filter(held).count()
    have = stream.stored_silver(spark, f"{tmp_path}/silver")
    raw = envelope.filter(F.col("kafka_offset") < 10_000_000_000)
    lost = stream.missing(raw, have)
    valid = quality.passed(silver.stream_trips(raw.filter(F.col("kafka_timestamp") < F.lit(cut))), quality.STREAM_RULES)
    names = ["kafka_partition", "kafka_offset"]
    kept_keys = have.kept.select("pickup_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount")
    want = valid.join(kept_keys, kept_keys.columns, "left_anti")
    same(lost.select(*names), want.select(*names))
    assert not lost.isEmpty()


@pytest.mark.parametrize("stop", [0, 1])
def test_a_batch_stopped_between_its_writes_is_written_once(spark, tmp_path, stop):
    once, again, _ = sent(spark)

    def fail(number: int) -> None:
        if number == stop:
            raise RuntimeError("stopped between the writes")

    def run(folder, between):
        for part in (once, again):
            part.coalesce(1).write.mode("append").parquet(f"{folder}/landing")
            source = readers.message_folder_stream(spark, f"{folder}/landing", files_per_batch=1)
            args = (source, f"{folder}/silver", f"{folder}/counts", f"{folder}/state")
            try:
                stream.drain_silver(*args, delay="9000 days", between=between)
            except Exception as error:
                assert "stopped between the writes" in str(error)
                stream.drain_silver(*args, delay="9000 days")
        return stream.stored_silver(spark, f"{folder}/silver"), spark.read.parquet(f"{folder}/counts")

    stopped, counts = run(tmp_path / "a", fail)
    plain, plain_counts = run(tmp_path / "b", None)
    volatile = ["ingestion_timestamp", "silver_timestamp"]
    for a, b in ((stopped.kept, plain.kept), (stopped.dead_letters, plain.dead_letters), (counts, plain_counts)):
        same(a.drop(*volatile), b.drop(*volatile))
