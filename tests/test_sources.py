"""Readers, drops, sinks, catalogue and the stream."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregrid.operators import conform, envelope
from faregrid.session import clear_scratch, shared_dir, staged
from faregrid.sources import catalogue, drops, readers, sinks
from faregrid.streaming import ingest

TYPES = {"VendorID": T.LongType(), "airport_fee": T.DoubleType(), "flag": T.StringType()}


def write_drop(spark, path, select):
    spark.range(10).selectExpr(*select).coalesce(1).write.parquet(path)


@pytest.fixture
def drop_list(spark, tmp_path):
    folder = str(tmp_path)
    write_drop(
        spark,
        f"{folder}/t_2020-01.parquet",
        ["cast(id as int) VendorID", "cast(1 as int) airport_fee", "'Y' flag"],
    )
    write_drop(
        spark, f"{folder}/t_2020-02.parquet", ["id VendorID", "1.5D Airport_fee", "'N' flag"]
    )
    write_drop(spark, f"{folder}/t_2020-03.parquet", ["id VendorID", "cast(7 as int) flag", "'x' more"])
    (tmp_path / "t_2020-04.parquet").write_bytes(b"not a parquet file")
    return [drops.Drop(2020, m, f"{folder}/t_2020-{m:02d}.parquet") for m in range(1, 6)]


def test_drops_land_once_and_failures_are_reported(spark, drop_list, tmp_path):
    target = str(tmp_path / "landed")
    for _run in range(2):
        report = drops.ingest(spark, drop_list, TYPES, target)
    rows = {r.month: (r.status, r["rows"], r.reason is None) for r in report.collect()}
    assert rows == {
        1: ("ok", 10, True),
        2: ("ok", 10, True),
        3: ("ok", 10, True),
        4: ("failed", 0, False),
        5: ("failed", 0, False),
    }
    table = readers.lake_table(spark, target)
    assert table.count() == 30
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    assert kinds["VendorID"] == "bigint" and kinds["airport_fee"] == "double"
    by_month = {
        r.puMonth: (r.fee, r.flag, r.more)
        for r in table.groupBy("puMonth")
        .agg(F.max("airport_fee").alias("fee"), F.max("flag").alias("flag"), F.max("more").alias("more"))
        .collect()
    }
    assert by_month == {1: (1.0, "Y", None), 2: (1.5, "N", None), 3: (None, "7", "x")}


def test_widening_drops_share_one_scan(spark, drop_list, plan_text):
    seen = drops.inspect(spark, drop_list[:2])
    plan = plan_text(drops.read_drops(spark, seen, TYPES)).split("\n\n")[0]
    assert plan.count("Scan parquet") == 1


def test_damaged_pages_fail_one_drop_only(spark, tmp_path):
    folder = str(tmp_path)
    for month in (1, 2):
        rows = spark.range(20_000).selectExpr("id VendorID", "rand(1) airport_fee", "'a' flag")
        rows.coalesce(1).write.option("compression", "snappy").parquet(f"{folder}/t_2020-{month:02d}.parquet")
    data = next((tmp_path / "t_2020-02.parquet").glob("part-*.parquet"))
    content = bytearray(data.read_bytes())
    content[4 : len(content) // 2] = b"\xff" * (len(content) // 2 - 4)
    data.write_bytes(bytes(content))
    for checksum in (tmp_path / "t_2020-02.parquet").glob(".part-*.crc"):
        checksum.unlink()
    listed = [drops.Drop(2020, m, f"{folder}/t_2020-{m:02d}.parquet") for m in (1, 2)]
    report = drops.ingest(spark, listed, TYPES, f"{folder}/landed")
    found = {r.month: (r.status, r["rows"], r.reason is None) for r in report.collect()}
    assert found == {1: ("ok", 20_000, True), 2: ("failed", 0, False)}


def test_drops_without_a_month_in_their_names(spark, tmp_path):
    folder, target = str(tmp_path), str(tmp_path / "landed")
    spark.range(10).selectExpr("id VendorID").write.parquet(f"{folder}/january.parquet")
    spark.range(7).selectExpr("id VendorID").write.parquet(f"{folder}/february file.parquet")
    listed = [
        drops.Drop(2020, 1, f"{folder}/january.parquet"),
        drops.Drop(2020, 2, f"{folder}/february file.parquet"),
    ]
    report = drops.ingest(spark, listed, TYPES, target)
    assert {(r.month, r.status, r["rows"]) for r in report.collect()} == {(1, "ok", 10), (2, "ok", 7)}
    assert readers.lake_table(spark, target).groupBy("puMonth").count().count() == 2
    # a later run counts only what it lands
    gone = [listed[0], drops.Drop(2020, 2, f"{folder}/gone.parquet")]
    again = {r.month: (r.status, r["rows"]) for r in drops.ingest(spark, gone, TYPES, target).collect()}
    assert again == {1: ("ok", 10), 2: ("failed", 0)}
    with pytest.raises(ValueError):
        drops.inspect(spark, [listed[0], listed[0]])


def test_files_of_one_drop_may_differ(spark, tmp_path):
    folder = tmp_path / "t_2020-01.parquet"
    spark.range(4).selectExpr("cast(id as int) VendorID", "'1' flag", "1 odd").coalesce(1).write.parquet(str(folder))
    spark.range(6).selectExpr("id VendorID", "2.5D airport_fee", "date'2020-01-01' odd").coalesce(1).write.mode(
        "append"
    ).parquet(str(folder))
    seen = drops.inspect(spark, [drops.Drop(2020, 1, str(folder))])
    assert not seen.failures and len(seen.parts) == 2
    target = str(tmp_path / "landed")
    report = drops.ingest(spark, [drops.Drop(2020, 1, str(folder))], TYPES, target)
    assert [(r.status, r["rows"]) for r in report.collect()] == [("ok", 10)]
    table = readers.lake_table(spark, target)
    assert dict(table.dtypes)["odd"] == "string"
    assert {r.odd for r in table.collect()} == {"1", "2020-01-01"}


def test_other_failures_are_raised(spark, drop_list, tmp_path):
    (tmp_path / "landed").write_text("a file where the table should be")
    with pytest.raises(Exception):
        drops.ingest(spark, drop_list[:1], TYPES, str(tmp_path / "landed"))


def test_all_drops_missing(spark, tmp_path):
    report = drops.ingest(
        spark, [drops.Drop(2020, 1, str(tmp_path / "none.parquet"))], TYPES, str(tmp_path / "x")
    )
    row = report.first()
    assert (row.status, row["rows"]) == ("failed", 0)


def test_schema_drift(spark, drop_list):
    found = drops.drift(spark, drops.inspect(spark, drop_list), TYPES)
    assert {(r.drop, r.column, r.found, r.difference) for r in found.collect()} == {
        ("2020-01", "VendorID", "int", "type"),
        ("2020-01", "airport_fee", "int", "type"),
        ("2020-02", "airport_fee", "double", "name"),
        ("2020-03", "airport_fee", None, "absent"),
        ("2020-03", "flag", "int", "type"),
    }


def test_conform_keeps_other_columns(spark):
    rows = spark.range(1).selectExpr("cast(id as int) vendorid", "1 AS other")
    out = conform.conform(rows, TYPES)
    assert out.columns == ["other", "VendorID", "airport_fee", "flag"]
    assert out.first().airport_fee is None


def test_replace_partitions_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2020, 1), (2, 2020, 2)], "v int, puYear int, puMonth int")
    sinks.replace_all(rows, path, sinks.PARTITIONS)
    sinks.replace_partitions(rows.filter("puMonth = 2").withColumn("v", F.lit(9)), path)
    assert {(r.v, r.puMonth) for r in spark.read.parquet(path).collect()} == {(1, 1), (9, 2)}
    sinks.replace_all(rows.filter("puMonth = 1"), path, sinks.PARTITIONS)
    assert spark.read.parquet(path).count() == 1


def test_year_filter_prunes_partitions(spark, tmp_path, plan_text):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2020, 1), (2, 2021, 2)], "v int, puYear int, puMonth int")
    sinks.replace_all(rows, path, sinks.PARTITIONS)
    plan = plan_text(spark.read.parquet(path).filter("puYear = 2021"))
    assert "PartitionFilters: [isnotnull(puYear" in plan


def test_dead_letters_are_counted_as_stored(spark, tmp_path):
    path = str(tmp_path / "bad")
    assert sinks.write_dead_letters(spark.range(7).toDF("v"), path) == 7
    assert spark.read.parquet(path).count() == 7
    # a run without bad rows leaves none of the run before
    assert sinks.write_dead_letters(spark.range(0).toDF("v"), path) == 0
    assert spark.read.parquet(path).count() == 0


def test_materialise(spark, tmp_path):
    sinks.materialise(spark.range(3), "stg_rows", "view")
    assert spark.table("stg_rows").count() == 3
    for rows in (4, 5):
        sinks.materialise(spark.range(rows), "mart_rows", "table", str(tmp_path / "mart"))
        assert spark.table("mart_rows").count() == rows
    with pytest.raises(ValueError):
        sinks.materialise(spark.range(3), "rows", "other")


def test_csv_round_trip_and_glob(spark, tmp_path):
    for year in (2019, 2020):
        rows = spark.createDataFrame(
            [(f"{year}-01-01T00:00:00", "+0010,1,N,1", "x", None)],
            readers.STATION_REPORT_SCHEMA,
        )
        sinks.export_csv(rows, str(tmp_path / f"weather_{year}"))
    reports = readers.station_reports(spark, str(tmp_path / "weather_*"))
    assert {r.DATE[:4] for r in reports.collect()} == {"2019", "2020"}
    assert {f.dataType for f in reports.schema.fields} == {T.StringType()}


def test_zone_lookup_keeps_not_available_as_text(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n264,"N/A","NV","N/A"\n1,"","x","y"\n')
    rows = {r.location_id: r.borough for r in readers.zone_lookup(spark, str(path)).collect()}
    assert rows == {264: "N/A", 1: None}


def test_values_table(spark):
    rows = [(1, "it's", None, True), (2, "back\\slash", 1.5, False)]
    table = readers.values_table(spark, rows, ["a", "b", "c", "d"])
    assert [(r.a, r.b, None if r.c is None else float(r.c), r.d) for r in table.collect()] == rows


def test_driver_rows_have_a_size_and_are_the_side_that_is_broadcast(spark, plan_text):
    rows = [(1, "card", 0.02), (2, "cash", None), (4, None, 1.5)]
    fees = readers.rows_table(spark, rows, "code long, label string, fee double")
    assert fees.dtypes == [("code", "bigint"), ("label", "string"), ("fee", "double")]
    assert sorted(map(tuple, fees.collect())) == rows
    assert readers.rows_table(spark, [], "code long").count() == 0
    large = spark.range(10_000_000).withColumnRenamed("id", "code")
    plan = plan_text(large.join(fees, "code")).split("\n\n")[0]
    assert "LocalTableScan" in plan and "BuildRight" in plan and "SortMergeJoin" not in plan


def test_calendar(spark):
    assert readers.calendar_range(spark, "2019-01-01", "2025-12-31").count() == 2557


def test_schemas_as_rows(spark):
    rows = readers.describe_columns({"t": spark.range(1)}, spark).collect()
    assert [tuple(r) for r in rows] == [("t", 0, "id", "bigint")]


def test_missing_tables_are_skipped(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "dim_zone"))
    found, skipped = catalogue.register_folder(spark, str(tmp_path), ["dim_zone", "dim_time"])
    assert (found, skipped) == (["dim_zone"], ["dim_time"])
    assert catalogue.profile({"dim_zone": spark.table("dim_zone")}).first()["rows"] == 4


def test_broken_tables_are_not_skipped(spark, tmp_path):
    (tmp_path / "dim_zone").mkdir()
    with pytest.raises(AnalysisException):
        catalogue.register_folder(spark, str(tmp_path), ["dim_zone"])


def test_read_only_sql(spark):
    catalogue.register({"dim_zone": spark.range(3000).toDF("location_id")})
    run = catalogue.read_only_sql
    assert run(spark, "SELECT * FROM dim_zone;").count() == 3000
    assert run(spark, "SELECT * FROM dim_zone;", rows=100).count() == 100
    assert run(spark, "```sql\nSELECT * FROM dim_zone LIMIT 7```").count() == 7
    nested = "SELECT * FROM dim_zone a JOIN (SELECT max(location_id) m FROM dim_zone) b ON a.location_id = b.m"
    assert run(spark, nested).count() == 1
    assert run(spark, "SELECT (SELECT count(*) FROM dim_zone) AS n FROM dim_zone").first()["n"] == 3000
    with pytest.raises(ValueError):
        run(spark, "SELECT * FROM dim_zone", rows=5000)


def test_read_only_sql_refuses_what_is_not_listed(spark, tmp_path):
    catalogue.register({"dim_zone": spark.range(3).toDF("id"), "secret_table": spark.range(3).toDF("id")})
    path = str(tmp_path / "hidden")
    spark.range(3).write.parquet(path)
    for text in (
        "DROP TABLE dim_zone",
        "SELECT * FROM other",
        "SELECT * FROM dim_zone LIMIT 2000",
        "SELECT * FROM secret_table LIMIT 5",
        "SELECT * FROM `secret_table` LIMIT 5",
        "SELECT * FROM dim_zone, secret_table LIMIT 5",
        "SELECT * FROM dim_zone, `secret_table` -- LIMIT 5",
        "SELECT (SELECT max(id) FROM `secret_table`) FROM dim_zone LIMIT 5",
        "SELECT * FROM dim_zone WHERE id IN (SELECT id FROM `secret_table`) LIMIT ALL",
        f"SELECT * FROM `parquet`.`{path}` LIMIT 5",
        f"SELECT * FROM dim_zone, `parquet`.`{path}` /* LIMIT 5 */",
        "SELECT java_method('java.lang.System', 'lineSeparator') FROM dim_zone LIMIT 1",
        "SELECT 1 FROM dim_zone LIMIT 1; SELECT 2",
        "INSERT INTO dim_zone VALUES (1)",
        "",
    ):
        with pytest.raises(ValueError):
            catalogue.read_only_sql(spark, text)


def test_limits_are_explicit(spark):
    assert catalogue.limited(spark.range(5000)).count() == 5000
    assert catalogue.limited(spark.range(5000), 40).count() == 40
    with pytest.raises(ValueError):
        catalogue.limited(spark.range(5000), 4000)
    rows = catalogue.sample_rows(spark.range(4000), "id", 0.25)
    assert 850 < rows.count() < 1150
    assert rows.count() == catalogue.sample_rows(spark.range(4000).repartition(7), "id", 0.25).count()


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (configured or shared_dir(spark)).rstrip("/")


def test_scratch_is_removed_on_request(spark):
    clear_scratch(spark)
    stored = staged(spark.range(5), "once")
    assert stored.count() == 5 and clear_scratch(spark) == 1
    with pytest.raises(Exception):
        staged(spark.range(5), "twice").filter("id > 0").sparkSession.read.parquet(
            stored.inputFiles()[0]
        ).count()
    assert clear_scratch(spark) == 1


PAYLOADS = [
    '{"vendor_id":"1","pickup_datetime":"2024-01-01 10:00:00","fare_amount":1.005,"payment_type":1}',
    "not json",
    '{"fare_amount":NaN,"trip_distance":"far","vendor_id":"2"}',
    '{"pickup_datetime":"NaT","passenger_count":2.0}',
    None,
]


def test_payload_edges(spark):
    rows = spark.createDataFrame(
        [(i, p) for i, p in enumerate(PAYLOADS)], "kafka_offset bigint, raw_json string"
    ).withColumns({"kafka_partition": F.lit(0), "ingestion_timestamp": F.current_timestamp()})
    found = envelope.decode_payload(rows).orderBy("kafka_offset").collect()
    assert len(found) == 5
    assert (found[0].vendor_id, found[0].fare_amount, found[0].payment_type) == ("1", 1.01, 1)
    assert found[0].pickup_datetime.hour == 10
    assert found[1].vendor_id is None and found[4].vendor_id is None
    assert (found[2].fare_amount, found[2].trip_distance) == (None, None)
    assert (found[3].pickup_datetime, found[3].passenger_count) == (None, 2)


def test_json_is_parsed_once_whatever_the_filters(spark, plan_text):
    rows = spark.range(3).selectExpr(
        "cast(id as string) raw_json", "0 kafka_partition", "id kafka_offset",
        "current_timestamp() ingestion_timestamp",
    )
    decoded = envelope.decode_payload(rows).filter("fare_amount BETWEEN 0 AND 5 AND vendor_id > ''")
    assert plan_text(decoded).split("\n\n", 1)[1].count("from_json") <= 1


def messages(spark, first, last):
    return spark.range(first, last).select(
        F.concat(F.lit("m"), "id").cast("binary").alias("value"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def test_stream_resumes_without_loss_or_repeats(spark, tmp_path):
    landing, raw, state = (str(tmp_path / x) for x in ("landing", "raw", "state"))
    messages(spark, 0, 50).write.parquet(landing)
    ingest.drain_raw_ingest(readers.message_folder_stream(spark, landing), raw, state)
    ingest.drain_raw_ingest(readers.message_folder_stream(spark, landing), raw, state)
    assert spark.read.parquet(raw).count() == 50
    messages(spark, 50, 80).write.mode("append").parquet(landing)
    stream = readers.message_folder_stream(spark, landing, files_per_batch=1)
    ingest.drain_raw_ingest(stream, raw, state)
    offsets = sorted(r.kafka_offset for r in spark.read.parquet(raw).collect())
    assert offsets == list(range(80))


def test_stream_stops_cleanly(spark, tmp_path):
    landing, raw, state = (str(tmp_path / x) for x in ("landing", "raw", "state"))
    messages(spark, 0, 5).write.parquet(landing)
    query = ingest.start_raw_ingest(
        readers.message_folder_stream(spark, landing), raw, state, interval="1 second"
    )
    query.processAllAvailable()
    query.stop()
    ingest.run_until_stopped(query)
    assert not query.isActive and spark.read.parquet(raw).count() == 5


def test_topic_reader_options(spark):
    """Without the connector on the class path the source is unknown, nothing else."""
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.topic_stream(spark, "localhost:1", "trips")
