"""Registered queries over sources, columns, rules, duplicates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.functions import labels, timeparts
from faregrid.operators import conform, dedup, envelope, lookups, quality, weather
from faregrid.plans import gold, questions, silver
from faregrid.session import scratch_path, staged
from faregrid.sources import catalogue, drops, readers, sinks
from faregrid.streaming import ingest
from workload import adapters, inputs
from workload import oracle as o
from workload.registry import query

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# sources ---------------------------------------------------------------------------------


@query(
    "s5_weather_csv_typed",
    o.sql("SELECT * FROM hourly_strict", "hourly_strict"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "hourly-csv")
    sinks.export_csv(inputs.hourly_strict(spark, sf), path)
    return readers.hourly_weather_file(spark, path)


@query(
    "s6_station_csv_glob",
    o.sql(
        "SELECT d[1:4] AS year, " + o.n() + " AS reports, " + o.n("aa1") + " AS with_rain, "
        "min(d) AS first_report, max(d) AS last_report FROM reports GROUP BY ALL",
        "reports",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "reports")
    yearly = adapters.station_reports(spark, sf).withColumn("year", F.substring("DATE", 1, 4))
    yearly.write.partitionBy("year").option("header", True).csv(folder)
    reports = readers.station_reports(spark, f"{folder}/year=*", readers.STATION_REPORT_SCHEMA)
    return reports.groupBy(F.substring("DATE", 1, 4).alias("year")).agg(
        F.count(F.lit(1)).alias("reports"),
        F.count("AA1").alias("with_rain"),
        F.min("DATE").alias("first_report"),
        F.max("DATE").alias("last_report"),
    )


@query("s7_zone_lookup", o.sql("SELECT * FROM zones", "zones"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "zone-csv")
    lookup = adapters.zones(spark, sf).select(
        F.col("location_id").alias("LocationID"),
        F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"),
        "service_zone",
    )
    sinks.export_csv(lookup, path)
    return readers.zone_lookup(spark, path)


REGION_ORDINALS = {"AFRICA": 1, "AMERICA": 2, "ASIA": 3, "EUROPE": 4}


@query(
    "s9_values_join",
    "SELECT r_name, ordinal, " + o.n() + " AS suppliers FROM supplier "
    "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
    "LEFT JOIN (VALUES ('AFRICA', 1), ('AMERICA', 2), ('ASIA', 3), ('EUROPE', 4)) AS t(name, ordinal) "
    "ON r_name = name GROUP BY ALL",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Inline values as a lookup; regions that are not listed stay, without a number."""
    known = readers.values_table(spark, list(REGION_ORDINALS.items()), ["r_name", "ordinal"])
    supplier, nation, region = (
        adapters.table(spark, sf, name) for name in ("supplier", "nation", "region")
    )
    located = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        located.join(known, "r_name", "left")
        .groupBy("r_name", "ordinal")
        .agg(F.count(F.lit(1)).alias("suppliers"))
    )


PAYMENT_FEES = [(1, "card", 0.02), (2, "cash", None), (4, "dispute", 1.5)]


@query(
    "s8_driver_rows",
    "SELECT label, fee, " + o.n() + " AS trips FROM (" + o.sql("SELECT pay FROM metered_lines", "metered_lines")
    + ") JOIN (VALUES (1, 'card', CAST(0.02 AS DOUBLE)), (2, 'cash', NULL), (4, 'dispute', 1.5)) "
    "AS t(code, label, fee) ON pay = code GROUP BY ALL",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fees = readers.rows_table(spark, PAYMENT_FEES, "code long, label string, fee double")
    trips = adapters.metered_bronze(spark, sf).groupBy(F.col("payment_type").alias("code")).count()
    return trips.join(fees, "code").groupBy("label", "fee").agg(F.sum("count").alias("trips"))


@query(
    "s13_schemas",
    "SELECT table_name, CAST(ordinal_position - 1 AS INTEGER) AS position, column_name, "
    "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' ELSE 'timestamp_ntz' END AS column_type "
    "FROM information_schema.columns WHERE table_name IN (" + ", ".join(f"'{t}'" for t in TABLES) + ")",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return readers.describe_columns({t: adapters.table(spark, sf, t) for t in TABLES}, spark)


@query(
    "l5_sampled_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "WHERE CAST('0x' || md5(CAST(o_orderkey AS VARCHAR))[1:8] AS BIGINT) < 0.1 * 4294967296",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the orders, the same ones every time."""
    orders = adapters.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return catalogue.sample_rows(orders, "o_orderkey", 0.1)


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar from the first to the last day of the trips."""
    days = adapters.table(spark, sf, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("first_day"),
        F.max("l_shipdate").cast("date").alias("last_day"),
    )
    return gold.calendar(readers.calendar_days(days))


@query("s10_p11_calendar", o.sql("SELECT * FROM calendar", "calendar"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _calendar(spark, sf).withColumn("date", F.col("date").cast("string"))


@query(
    "s12_s13_table_profile",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, {o.n()} AS rows FROM {t}" for t in TABLES),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    names = catalogue.register({t: adapters.table(spark, sf, t) for t in TABLES})
    return catalogue.profile({name: spark.table(name) for name in names})


def _written_drops(spark: SparkSession, sf: str) -> list[drops.Drop]:
    """Metered trips as one folder per year, with the drift real drops have.

    Early years carry narrow ids, a renamed fee and no surcharge; an expected
    drop that never arrived is part of the list.
    """
    folder = scratch_path(spark, "drops")
    trips = adapters.metered_bronze(spark, sf)
    early = F.col("puYear") < 1998
    narrow = (
        trips.filter(early)
        .withColumns(
            {
                "VendorID": F.col("VendorID").cast("int"),
                "PULocationID": F.col("PULocationID").cast("int"),
                "airport_fee": F.lit(0).cast("int"),
            }
        )
        .withColumnRenamed("airport_fee", "Airport_fee")
        .drop("congestion_surcharge")
    )
    for part in (narrow, trips.filter(~early)):
        drop = F.concat(F.col("puYear").cast("string"), F.lit("-01"))
        part.withColumn("drop", drop).drop("puYear", "puMonth").write.mode("append").partitionBy(
            "drop"
        ).parquet(folder)
    years = sorted(r["puYear"] for r in trips.select("puYear").distinct().collect())
    # one more is expected that never arrived
    return [drops.Drop(y, 1, f"{folder}/drop={y}-01") for y in [*years, years[-1] + 1]]


@query(
    "s14_drop_ingest_report",
    o.sql(
        "SELECT y AS year, CAST(1 AS INTEGER) AS month, "
        "CASE WHEN max(py) IS NULL THEN 'failed' ELSE 'ok' END AS status, "
        + o.n("py")
        + " AS rows FROM (SELECT DISTINCT py AS y FROM metered_lines UNION ALL "
        "SELECT max(py) + 1 FROM metered_lines) LEFT JOIN metered_lines ON py = y GROUP BY y",
        "metered_lines",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    landed = scratch_path(spark, "landed")
    report = drops.ingest(
        spark, _written_drops(spark, sf), conform.METERED_TYPES, landed
    )
    return report.drop("reason")


@query(
    "s15_schema_drift",
    o.sql(
        "SELECT py || '-01' AS drop, c.column, c.registered, c.found, c.difference "
        "FROM (SELECT DISTINCT py FROM metered_lines WHERE py < 1998), (VALUES "
        "('VendorID', 'bigint', 'int', 'type'), ('PULocationID', 'bigint', 'int', 'type'), "
        "('airport_fee', 'double', 'int', 'type'), "
        "('congestion_surcharge', 'double', NULL, 'absent')) "
        'AS c("column", registered, found, difference)',
        "metered_lines",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    seen = drops.inspect(spark, _written_drops(spark, sf))
    return drops.drift(spark, seen, conform.METERED_TYPES)


@query(
    "p5_a9_landed_partitions",
    o.sql(
        f'SELECT py AS "puYear", CAST(1 AS INTEGER) AS "puMonth", {o.n()} AS rows, '
        f"{o.countif('py >= 1998')} AS with_surcharge, sum(pu)::BIGINT AS zone_sum "
        "FROM metered_lines GROUP BY py",
        "metered_lines",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    landed = scratch_path(spark, "landed")
    expected = _written_drops(spark, sf)
    for _run in range(2):  # a repeated run replaces its partitions
        drops.ingest(spark, expected, conform.METERED_TYPES, landed)
    table = readers.lake_table(spark, landed)
    counted = drops.partition_audit(table)
    extra = table.groupBy("puYear", "puMonth").agg(
        F.count("congestion_surcharge").alias("with_surcharge"),
        F.sum("PULocationID").alias("zone_sum"),
    )
    return counted.join(extra, ["puYear", "puMonth"])


# sinks -----------------------------------------------------------------------------------


@query(
    "k2_append_merged_schema",
    o.sql(
        "SELECT py AS \"puYear\", " + o.n() + " AS rows, "
        + o.countif("py >= 1998") + " AS with_label FROM metered_lines GROUP BY py",
        "metered_lines",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "append")
    trips = adapters.metered_bronze(spark, sf)
    early = F.col("puYear") < 1998
    sinks.append_partitioned(trips.filter(early), path)
    labelled = trips.filter(~early).withColumn("label", labels.payment_label(F.col("payment_type")))
    sinks.append_partitioned(labelled, path)
    table = spark.read.option("mergeSchema", True).parquet(path)
    return table.groupBy("puYear").agg(
        F.count(F.lit(1)).alias("rows"), F.count("label").alias("with_label")
    )


@query(
    "k3_v8_partitioned_year",
    o.sql(
        "SELECT pm AS month, " + o.n() + " AS trips FROM silver WHERE py = 1998 GROUP BY pm",
        "silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    kept = silver.metered_silver(adapters.metered_bronze(spark, sf)).kept
    sinks.replace_all(kept, path, sinks.PARTITIONS)
    table = readers.lake_table(spark, path).filter(F.col("puYear") == 1998)
    return table.groupBy(F.col("puMonth").alias("month")).agg(F.count(F.lit(1)).alias("trips"))


@query(
    "k5_dead_letter_table",
    o.sql(
        "SELECT "
        + ", ".join(f"coalesce({test}, FALSE) AS {flag}" for flag, test in o.STREAM_RULES.items())
        + ", " + o.n() + " AS rows FROM stream_trips "
        f"WHERE NOT coalesce({o.STREAM_OK}, FALSE) GROUP BY ALL",
        "stream_trips",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "dead-letters")
    rejected = silver.stream_silver(inputs.envelope(spark, sf)).dead_letters
    sinks.write_dead_letters(rejected, path)
    flags = [rule.flag for rule in quality.STREAM_RULES]
    letters = readers.lake_table(spark, path).filter(F.col("failure_timestamp").isNotNull())
    return letters.groupBy(*flags).agg(F.count(F.lit(1)).alias("rows"))


# stream ----------------------------------------------------------------------------------


@query(
    "t1_stream_restart",
    o.sql(
        "SELECT part AS kafka_partition, " + o.n() + " AS messages, "
        "min(off) AS first_offset, max(off) AS last_offset FROM messages GROUP BY part",
        "messages",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over a growing folder with one checkpoint: nothing lost, nothing twice."""
    landing, raw, state = (scratch_path(spark, x) for x in ("landing", "raw", "state"))
    messages = adapters.messages(spark, sf)
    for late in (False, True):
        part = messages.filter((F.col("offset") >= 10_000_000_000) == late)
        part.write.mode("append").parquet(landing)
        ingest.drain_raw_ingest(readers.message_folder_stream(spark, landing), raw, state)
    return (
        readers.lake_table(spark, raw)
        .groupBy("kafka_partition")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("kafka_offset").alias("first_offset"),
            F.max("kafka_offset").alias("last_offset"),
        )
    )


@query(
    "p1_raw_envelope",
    o.sql(
        "SELECT part AS kafka_partition, off AS kafka_offset, "
        + o.ts("dropoff")
        + f" AS kafka_timestamp, NOT ({o.LOST}) AS is_json FROM messages",
        "messages",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = inputs.envelope(spark, sf).filter(F.col("ingestion_timestamp").isNotNull())
    return inputs.texts(raw, "kafka_timestamp").select(
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.col("raw_json").startswith("{").alias("is_json"),
    )


@query(
    "p2_decode_payload",
    o.sql(
        "SELECT * REPLACE (" + o.ts("pickup_datetime") + " AS pickup_datetime, "
        + o.ts("dropoff_datetime") + " AS dropoff_datetime) FROM stream_trips",
        "stream_trips",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    decoded = envelope.decode_payload(inputs.envelope(spark, sf))
    return inputs.texts(decoded, "pickup_datetime", "dropoff_datetime").drop(
        "ingestion_timestamp", "silver_timestamp"
    )


@query(
    "p24_encode_payload",
    o.sql(
        "SELECT CAST(VendorID AS VARCHAR) AS vendor_id, " + o.ts("pickup") + " AS pickup_datetime, "
        "coalesce(passengers, 0) AS passenger_count, fare AS fare_amount, tot AS total_amount, "
        "pay AS payment_type, " + o.n() + " AS copies FROM metered_lines GROUP BY ALL",
        "metered_lines",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    encoded = envelope.encode_payload(
        adapters.metered_bronze(spark, sf),
        stamp=F.date_format("tpep_dropoff_datetime", "yyyy-MM-dd'T'HH:mm:ss"),
    )
    kinds = {
        "vendor_id": "string",
        "pickup_datetime": "string",
        "passenger_count": "double",
        "fare_amount": "double",
        "total_amount": "double",
        "payment_type": "bigint",
    }
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    fields = encoded.select(F.inline(F.array(F.from_json("raw_json", schema))))
    return fields.groupBy(*kinds).agg(F.count(F.lit(1)).alias("copies"))


# derived columns -------------------------------------------------------------------------


@query(
    "p3_time_features_lake",
    o.sql(
        f"SELECT pu, {o.ts('pickup')} AS pickup, {o.HOUR} AS pickup_hour, "
        "CAST(month(pickup) AS INTEGER) AS pickup_month, CAST(year(pickup) AS INTEGER) AS pickup_year, "
        f"{o.DOW} AS pickup_dow, {o.WEEKEND} AS is_weekend, {o.RUSH_LAKE} AS is_rush_hour, "
        "strftime(pickup, '%Y-%m-%d') AS pickup_date_str FROM metered_lines",
        "metered_lines",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    timed = silver.metered_features(adapters.metered_bronze(spark, sf))
    return timed.select(
        F.col("PULocationID").alias("pu"),
        F.date_format("tpep_pickup_datetime", inputs.TIME_TEXT).alias("pickup"),
        "pickup_hour",
        "pickup_month",
        "pickup_year",
        "pickup_dow",
        "is_weekend",
        "is_rush_hour",
        "pickup_date_str",
    )


@query(
    "p3a_rush_hour_stream",
    o.sql(
        f"SELECT {o.HOUR} AS pickup_hour, {o.DOW} AS pickup_dow, {o.WEEKEND} AS is_weekend, "
        f"{o.RUSH_STREAM} AS is_rush_hour, {o.n()} AS trips FROM metered_lines GROUP BY ALL",
        "metered_lines",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    trips = adapters.metered_bronze(spark, sf)
    timed = timeparts.with_time_features(trips, "tpep_pickup_datetime", timeparts.STREAM_RUSH)
    keys = ["pickup_hour", "pickup_dow", "is_weekend", "is_rush_hour"]
    return timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"))


@query(
    "p3b_rush_hour_lake",
    o.sql(
        f"SELECT {o.HOUR} AS pickup_hour, {o.DOW} AS pickup_dow, {o.WEEKEND} AS is_weekend, "
        f"{o.RUSH_LAKE} AS is_rush_hour, {o.n()} AS trips FROM hail GROUP BY ALL",
        "hail",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    timed = silver.ride_hail_features(adapters.ride_hail_bronze(spark, sf))
    keys = ["pickup_hour", "pickup_dow", "is_weekend", "is_rush_hour"]
    return timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"))


@query(
    "p4_conform",
    'SELECT l_orderkey AS "VendorID", l_suppkey AS "PULocationID", l_partkey AS "DOLocationID", '
    'CAST(l_linenumber AS DOUBLE) AS passenger_count, CAST(NULL AS DOUBLE) AS "RatecodeID", '
    "CAST(l_linenumber AS DOUBLE) AS airport_fee, CAST(NULL AS DOUBLE) AS congestion_surcharge, "
    "l_returnflag FROM lineitem",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Narrow ids, a renamed fee, an absent surcharge and rate code, one extra column."""
    drifted = adapters.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("int").alias("VendorID"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_linenumber").alias("Airport_fee"),
        "l_returnflag",
    )
    return conform.conform(drifted, conform.METERED_TYPES)


@query(
    "p4_conform_ride_hail",
    'SELECT event_type, user_id AS "PULocationID", event_id AS "DOLocationID", '
    "CAST(floor(value) AS BIGINT) AS trip_time, CAST(NULL AS DOUBLE) AS airport_fee, "
    "value AS congestion_surcharge, CAST(event_id % 2 AS VARCHAR) AS wav_match_flag FROM events",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Narrow ids and times, a flag stored as a number, no airport fee."""
    drifted = adapters.table(spark, sf, "events").select(
        "event_type",
        F.col("user_id").cast("int").alias("pulocationid"),
        F.col("event_id").cast("int").alias("DOLocationID"),
        F.floor("value").cast("int").alias("trip_time"),
        F.col("value").alias("congestion_surcharge"),
        (F.col("event_id") % 2).cast("int").alias("wav_match_flag"),
    )
    return conform.conform(drifted, conform.RIDE_HAIL_TYPES)


@query(
    "p6_company",
    o.sql(
        f"SELECT licence, {o.COMPANY} AS company, {o.n()} AS trips FROM hail GROUP BY ALL", "hail"
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    trips = silver.ride_hail_features(adapters.ride_hail_bronze(spark, sf))
    return trips.groupBy(F.col("hvfhs_license_num").alias("licence"), "company").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query("p7_v14_weather_decode", o.sql("SELECT * FROM decoded", "decoded"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return weather.decode_reports(adapters.station_reports(spark, sf))


@query(
    "p7b_p8_weather_decode_strict",
    o.sql(f"SELECT *, {o.CONDITION} AS condition FROM decoded_strict", "decoded_strict"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return weather.decode_reports_strict(adapters.station_reports(spark, sf))


@query("a1_hourly_weather", o.sql("SELECT * FROM hourly", "hourly"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.hourly(spark, sf)


@query("a1b_hourly_weather_strict", o.sql("SELECT * FROM hourly_strict", "hourly_strict"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.hourly_strict(spark, sf)


@query(
    "a14_condition_counts",
    o.sql(f"SELECT condition, {o.n()} AS hours FROM hourly_strict GROUP BY condition", "hourly_strict"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return weather.condition_counts(inputs.hourly_strict(spark, sf))


@query("p9_metered_fact", o.sql("SELECT * FROM fact", "fact"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.metered_fact(spark, sf, with_hours=True)


@query("p10_ride_hail_fact", o.sql("SELECT * FROM hail_fact", "hail_fact"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.ride_hail_fact(spark, sf)


STAR_SQL = f"""
SELECT fare_amount, tip_amount, total_amount, trip_distance, passenger_count, payment_type,
  {o.rd("(epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60.0::DOUBLE")} AS trip_duration_minutes,
  {o.rd("CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END")} AS fare_per_mile,
  {o.rd("CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0::DOUBLE END")} AS tip_pct,
  pickup_location_id, dropoff_location_id, pickup_hour, pickup_month, pickup_year, pickup_dow,
  is_weekend, is_rush_hour, weather_condition, weather_temp_c, weather_precip_mm, weather_wind_kmh,
  {o.ts("pickup_datetime")} AS pickup_datetime, {o.ts("dropoff_datetime")} AS dropoff_datetime,
  vendor_id, kafka_offset
FROM stream_silver
WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND fare_amount > 0"""


@query("p12_p14_v6_star_fact", o.sql(STAR_SQL, "stream_silver"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact = gold.star_fact(inputs.stream_staged(spark, sf))
    return inputs.texts(fact, "pickup_datetime", "dropoff_datetime").drop(
        "ingestion_timestamp", "silver_timestamp"
    )


@query(
    "p15_p16_u4_star_clock",
    o.sql(
        "SELECT DISTINCT pickup_hour, pickup_month, pickup_year, pickup_dow, is_weekend, is_rush_hour, "
        "monthname(pickup_datetime) AS month_name, "
        "CASE WHEN pickup_hour BETWEEN 6 AND 11 THEN 'Morning' WHEN pickup_hour BETWEEN 12 AND 16 "
        "THEN 'Afternoon' WHEN pickup_hour BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END "
        "AS time_of_day FROM stream_silver",
        "stream_silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return gold.star_clock(gold_staged_without_weather(spark, sf))


def gold_staged_without_weather(spark: SparkSession, sf: str) -> DataFrame:
    return gold.staging(silver.stream_silver(inputs.envelope(spark, sf)).kept)


@query(
    "p17_borough_ordinal",
    o.sql(
        "SELECT *, CAST(CASE borough WHEN 'AFRICA' THEN 1 WHEN 'AMERICA' THEN 2 WHEN 'ASIA' THEN 3 "
        "WHEN 'EUROPE' THEN 4 ELSE 6 END AS INTEGER) AS borough_id FROM zones",
        "zones",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return gold.zones_with_ordinal(adapters.zones(spark, sf), REGION_ORDINALS)


@query(
    "p18_a8_star_weather",
    o.sql(
        f"SELECT weather_condition, {o.avg('weather_temp_c')} AS avg_temp_c, "
        f"{o.avg('weather_precip_mm')} AS avg_precip_mm, {o.avg('weather_wind_kmh')} AS avg_wind_kmh, "
        "CASE weather_condition WHEN 'Rain' THEN 'Precipitation expected, higher demand likely' "
        "WHEN 'Snow' THEN 'Severe weather, very high demand' WHEN 'Clear' THEN "
        "'Good conditions, normal demand' ELSE 'Unknown conditions' END AS demand_impact "
        "FROM (SELECT DISTINCT weather_condition, weather_temp_c, weather_precip_mm, weather_wind_kmh "
        "FROM stream_silver WHERE weather_condition IS NOT NULL) GROUP BY weather_condition",
        "stream_silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return gold.star_weather(inputs.stream_staged(spark, sf))


@query(
    "p19_p20_weather_buckets",
    o.sql(
        f"SELECT {o.TEMP_BUCKET} AS temp_bucket, {o.RAIN_BUCKET} AS rain_bucket, "
        "coalesce(CASE WHEN weather_temp_c IS NULL THEN 'No reading' END, "
        f"{o.TEMP_BUCKET}) AS own_bucket, {o.n()} AS hours FROM hourly GROUP BY ALL",
        "hourly",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    celsius = F.col("weather_temp_c")
    return (
        inputs.hourly(spark, sf)
        .select(
            labels.temperature_bucket(celsius).alias("temp_bucket"),
            labels.rain_bucket(F.col("weather_precip_mm")).alias("rain_bucket"),
            labels.temperature_bucket(celsius, "No reading").alias("own_bucket"),
        )
        .groupBy("temp_bucket", "rain_bucket", "own_bucket")
        .agg(F.count(F.lit(1)).alias("hours"))
    )


@query(
    "p22_staging_contract",
    o.sql(
        "SELECT vendor_id, kafka_partition, kafka_offset, payment_type, weather_condition, "
        + o.ts("pickup_datetime")
        + " AS pickup_datetime FROM stream_silver",
        "stream_silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    staged_rows = inputs.stream_staged(spark, sf)
    return inputs.texts(staged_rows, "pickup_datetime").select(
        "vendor_id",
        "kafka_partition",
        "kafka_offset",
        "payment_type",
        "weather_condition",
        "pickup_datetime",
    )


# rules -----------------------------------------------------------------------------------


def _flag_sql(rules: dict[str, str], source: str, strict: bool) -> str:
    def flag(test: str) -> str:
        return f"coalesce({test}, FALSE)" if strict else f"({test})"

    verdict = " AND ".join(rules.values())
    columns = ", ".join(f"{flag(test)} AS {name}" for name, test in rules.items())
    return o.sql(
        f"SELECT {columns}, {flag(verdict)} AS is_valid, {o.n()} AS rows FROM {source} GROUP BY ALL",
        source,
    )


def _flag_counts(flagged: DataFrame, rules) -> DataFrame:
    keys = [rule.flag for rule in rules] + ["is_valid"]
    return flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


@query("v1_rules_null_fails", _flag_sql(o.METERED_RULES, "metered_lines", strict=True))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rules = quality.METERED_RULES
    return _flag_counts(quality.with_flags(adapters.metered_bronze(spark, sf), rules), rules)


@query("v2_rules_null_unknown", _flag_sql(o.METERED_RULES, "metered_lines", strict=False))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rules = quality.METERED_RULES
    flagged = quality.with_flags(
        adapters.metered_bronze(spark, sf), rules, quality.NULL_UNKNOWN
    )
    return _flag_counts(flagged, rules)


@query("v3_ride_hail_rules", _flag_sql(o.HAIL_RULES, "hail", strict=True))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rules = quality.RIDE_HAIL_RULES
    return _flag_counts(quality.with_flags(adapters.ride_hail_bronze(spark, sf), rules), rules)


def _split_sql(verdict: str, failed: str) -> str:
    return o.sql(
        f"SELECT 'passed' AS branch, py AS year, {o.n()} AS trips FROM metered_lines "
        f"WHERE {verdict} GROUP BY py UNION ALL "
        f"SELECT 'failed', py, {o.n()} FROM metered_lines WHERE {failed} GROUP BY py",
        "metered_lines",
    )


def _branch_counts(passed: DataFrame, failed: DataFrame) -> DataFrame:
    counts = [
        branch.groupBy(F.col("puYear").alias("year"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select(F.lit(name).alias("branch"), "year", "trips")
        for name, branch in (("passed", passed), ("failed", failed))
    ]
    return counts[0].unionByName(counts[1])


@query("v4_split", _split_sql(o.METERED_OK, f"NOT coalesce({o.METERED_OK}, FALSE)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    trips, rules = adapters.metered_bronze(spark, sf), quality.METERED_RULES
    return _branch_counts(quality.passed(trips, rules), quality.failed(trips, rules))


@query("v4_split_null_unknown", _split_sql(o.METERED_OK, f"NOT ({o.METERED_OK})"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    trips, rules = adapters.metered_bronze(spark, sf), quality.METERED_RULES
    rejected = quality.failed(trips, rules, quality.NULL_UNKNOWN)
    return _branch_counts(quality.passed(trips, rules), rejected)


def _report_sql(rules: dict[str, str], source: str) -> str:
    ok = "coalesce(" + " AND ".join(rules.values()) + ", FALSE)"
    per_rule = ", ".join(
        o.countif(f"NOT coalesce({test}, FALSE)") + f" AS failed_{name}"
        for name, test in rules.items()
    )
    return o.sql(
        f"SELECT {o.n()} AS total_rows, {o.countif(ok)} AS passed_rows, "
        f"{o.countif(f'NOT {ok}')} AS failed_rows, {per_rule}, CAST(0 AS BIGINT) AS undecided_rows, "
        + o.pct(f"COUNT(*) FILTER (WHERE {ok})", "COUNT(*)")
        + f" AS pass_rate_pct FROM {source}",
        source,
    )


@query("v5_quality_report", _report_sql(o.METERED_RULES, "metered_lines"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.report(adapters.metered_bronze(spark, sf), quality.METERED_RULES)


@query("v5_quality_report_ride_hail", _report_sql(o.HAIL_RULES, "hail"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.report(adapters.ride_hail_bronze(spark, sf), quality.RIDE_HAIL_RULES)


@query(
    "v10_v12_table_checks",
    o.sql(
        "SELECT *, failing_rows = 0 AS passed FROM ("
        f"SELECT 'fact_trips' AS table_name, 'fare_amount' AS column_name, 'not_null' AS check_name, "
        f"{o.countif('fare IS NULL')} AS failing_rows FROM metered_lines UNION ALL "
        f"SELECT 'fact_trips', 'passenger_count', 'not_null', {o.countif('passengers IS NULL')} "
        "FROM metered_lines UNION ALL "
        f"SELECT 'fact_trips', 'payment_type', 'accepted_values', {o.countif('pay NOT IN (1, 2, 3)')} "
        "FROM metered_lines UNION ALL "
        f"SELECT 'fact_trips', 'total_amount', 'unique', {o.n()} FROM (SELECT tot FROM metered_lines "
        "GROUP BY tot HAVING COUNT(*) > 1) UNION ALL "
        f"SELECT 'dim_zone', 'borough', 'not_null', {o.countif('borough IS NULL')} FROM zones UNION ALL "
        f"SELECT 'dim_zone', 'location_id', 'unique', {o.n()} FROM (SELECT location_id FROM zones "
        "GROUP BY location_id HAVING COUNT(*) > 1) UNION ALL "
        "SELECT 'dim_weather', 'condition', 'accepted_values', "
        + o.countif("condition NOT IN ('Clear', 'Rain')")
        + " FROM hourly_strict)",
        "metered_lines",
        "zones",
        "hourly_strict",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_checks(
        {
            "fact_trips": (
                adapters.metered_bronze(spark, sf),
                [
                    quality.NotNull("fare_amount"),
                    quality.NotNull("passenger_count"),
                    quality.AcceptedValues("payment_type", (1, 2, 3)),
                    quality.Unique("total_amount"),
                ],
            ),
            "dim_zone": (
                adapters.zones(spark, sf),
                [quality.NotNull("borough"), quality.Unique("location_id")],
            ),
            "dim_weather": (
                inputs.hourly_strict(spark, sf),
                [quality.AcceptedValues("condition", ("Clear", "Rain"))],
            ),
        }
    )


# duplicates ------------------------------------------------------------------------------


def _silver_sql(source: str) -> str:
    return o.sql(
        f"SELECT {o.ts('pickup')} AS pickup, pu, dof, fare, {o.ts('dropoff')} AS dropoff, passengers, "
        f"distance, pay, tip, tot, py, pm FROM {source}",
        source,
    )


@query("u1_dedup_metered", _silver_sql("silver_redelivered"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    kept = silver.metered_silver(adapters.metered_redelivered(spark, sf)).kept
    return kept.select(
        F.date_format("tpep_pickup_datetime", inputs.TIME_TEXT).alias("pickup"),
        F.col("PULocationID").alias("pu"),
        F.col("DOLocationID").alias("dof"),
        F.col("fare_amount").alias("fare"),
        F.date_format("tpep_dropoff_datetime", inputs.TIME_TEXT).alias("dropoff"),
        F.col("passenger_count").alias("passengers"),
        F.col("trip_distance").alias("distance"),
        F.col("payment_type").alias("pay"),
        F.col("tip_amount").alias("tip"),
        F.col("total_amount").alias("tot"),
        F.col("puYear").alias("py"),
        F.col("puMonth").alias("pm"),
    )


@query(
    "u1_dedup_stream",
    o.sql(
        "SELECT kafka_partition, kafka_offset, " + o.ts("pickup_datetime") + " AS pickup_datetime, "
        "fare_amount, tip_amount, is_rush_hour FROM stream_silver",
        "stream_silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    kept = silver.stream_silver(inputs.envelope(spark, sf)).kept
    return inputs.texts(kept, "pickup_datetime").select(
        "kafka_partition",
        "kafka_offset",
        "pickup_datetime",
        "fare_amount",
        "tip_amount",
        "is_rush_hour",
    )


@query(
    "u2_dedup_ride_hail",
    o.sql(
        f"SELECT licence, {o.ts('pickup')} AS pickup, pu, dof, fare, tips, pay, py "
        "FROM hail_silver_redelivered",
        "hail_silver_redelivered",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    kept = silver.ride_hail_silver(adapters.ride_hail_redelivered(spark, sf)).kept
    return kept.select(
        F.col("hvfhs_license_num").alias("licence"),
        F.date_format("pickup_datetime", inputs.TIME_TEXT).alias("pickup"),
        F.col("PULocationID").alias("pu"),
        F.col("DOLocationID").alias("dof"),
        F.col("base_passenger_fare").alias("fare"),
        "tips",
        F.col("driver_pay").alias("pay"),
        F.col("puYear").alias("py"),
    )


@query(
    "u3_removed_rows",
    o.sql(
        f"SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed FROM "
        f"(SELECT {o.n()} AS b FROM redelivered WHERE {o.METERED_OK}), "
        f"(SELECT {o.n()} AS a FROM silver_redelivered)",
        "redelivered",
        "silver_redelivered",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    passed = quality.passed(adapters.metered_redelivered(spark, sf), quality.METERED_RULES)
    return dedup.removed_rows(passed, dedup.METERED_KEYS)


# joins -----------------------------------------------------------------------------------


@query(
    "j1_weather_left",
    o.sql(
        f"SELECT {o.ts('pickup')} AS pickup, pu, fare, weather_temp_c, weather_wind_kmh, weather_precip_mm "
        "FROM hail_silver s LEFT JOIN hourly h ON strftime(s.pickup, '%Y-%m-%d') = h.pickup_date_str "
        "AND hour(s.pickup) = h.pickup_hour",
        "hail_silver",
        "hourly",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    kept = silver.ride_hail_silver(adapters.ride_hail_bronze(spark, sf)).kept
    joined = lookups.with_weather(kept, staged(inputs.hourly(spark, sf), "weather"))
    return joined.select(
        F.date_format("pickup_datetime", inputs.TIME_TEXT).alias("pickup"),
        F.col("PULocationID").alias("pu"),
        F.col("base_passenger_fare").alias("fare"),
        "weather_temp_c",
        "weather_wind_kmh",
        "weather_precip_mm",
    )


@query(
    "j2_weather_file_left",
    o.sql(
        "SELECT s.kafka_partition, s.kafka_offset, w.hour, weather_temp_c, weather_precip_mm, "
        "weather_wind_kmh, weather_condition FROM stream_silver s LEFT JOIN hourly_strict w "
        "ON strftime(pickup_datetime, '%Y-%m-%d') = w.date AND pickup_hour = w.hour",
        "stream_silver",
        "hourly_strict",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "hourly-csv")
    sinks.export_csv(inputs.hourly_strict(spark, sf), path)
    found = readers.optional_hourly_weather(spark, path)
    kept = silver.stream_silver(inputs.envelope(spark, sf), found).kept
    return kept.select(
        "kafka_partition",
        "kafka_offset",
        "hour",
        "weather_temp_c",
        "weather_precip_mm",
        "weather_wind_kmh",
        "weather_condition",
    )


@query(
    "j2b_weather_absent",
    o.sql(
        "SELECT pickup_year, " + o.n() + " AS trips, CAST(0 AS BIGINT) AS with_weather "
        "FROM stream_silver GROUP BY pickup_year",
        "stream_silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    missing = readers.optional_hourly_weather(spark, scratch_path(spark, "no-weather"))
    kept = silver.stream_silver(inputs.envelope(spark, sf), missing).kept
    return kept.groupBy("pickup_year").agg(
        F.count(F.lit(1)).alias("trips"), F.count("weather_temp_c").alias("with_weather")
    )


@query(
    "j4_pickup_dropoff_boroughs",
    o.sql(
        f"SELECT p.borough AS pickup_borough, d.borough AS dropoff_borough, {o.n()} AS trips, "
        f"{o.mean('fare_amount')} AS avg_fare FROM fact f JOIN zones p ON pickup_location_id = p.location_id "
        "JOIN zones d ON dropoff_location_id = d.location_id GROUP BY ALL",
        "fact",
        "zones",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.trips_between_boroughs(
        inputs.metered_fact(spark, sf), adapters.zones(spark, sf)
    )


@query(
    "j4_calendar_day_names",
    o.sql(
        f"SELECT day_name, {o.n()} AS trips, {o.mean('fare_amount')} AS avg_fare FROM fact "
        "JOIN calendar USING (date_key) GROUP BY day_name",
        "fact",
        "calendar",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.trips_by_calendar(
        inputs.metered_fact(spark, sf), _calendar(spark, sf), "day_name"
    )


@query(
    "j6_weather_match_rate",
    o.sql(
        f"SELECT {o.n()} AS rows, {o.n('weather_temp_c')} AS matched, "
        + o.pct("COUNT(weather_temp_c)", "COUNT(*)")
        + " AS match_pct FROM fact",
        "fact",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.match_rate(inputs.metered_fact(spark, sf, with_hours=True))


@query(
    "v15_left_join_guard",
    o.sql(
        f"SELECT {o.n()} AS rows_before, {o.n()} AS rows_after, CAST(0 AS BIGINT) AS repeated_keys, "
        "TRUE AS unchanged FROM silver",
        "silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # stored once: the duplicates are not removed again for the rows after the join
    kept = staged(silver.metered_silver(adapters.metered_bronze(spark, sf)).kept, "kept")
    hours = staged(inputs.hourly(spark, sf), "weather")
    joined = lookups.with_weather(kept, hours)
    return lookups.row_count_guard(kept, joined, hours, lookups.WEATHER_KEYS)

