"""Registered queries over tables that are kept up to date: one-pass silver, stream, drops, sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.functions.measures import Measure, exact_mean, exact_sum
from faregrid.operators import quality
from faregrid.operators.tally import present, tally
from faregrid.plans import dayparts, gold, increments, onepass, summary
from faregrid.plans.jobs import FACT_PARTITIONS, Lake
from faregrid.session import scratch_path
from faregrid.sources import readers
from faregrid.streaming import silver as stream
from workload import adapters, inputs
from workload import oracle as o
from workload.registry import query


def _lake(spark: SparkSession, bronze: DataFrame) -> Lake:
    lake = Lake(scratch_path(spark, "lake"))
    bronze.write.parquet(lake.path("bronze/metered"))
    return lake


# one pass --------------------------------------------------------------------------------


@query(
    "v4_k5_one_pass_split",
    o.sql(
        f"SELECT 'kept' AS outcome, py AS year, {o.n()} AS trips, {o.total('tip', 2)} AS tips "
        "FROM silver_redelivered GROUP BY py UNION ALL "
        f"SELECT 'failed', py, {o.n()}, {o.total('tip', 2)} FROM redelivered "
        f"WHERE NOT coalesce({o.METERED_OK}, FALSE) GROUP BY py",
        "silver_redelivered",
        "redelivered",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Both branches as stored by one write over one scan."""
    lake = _lake(spark, adapters.metered_redelivered(spark, sf))
    onepass.split_job(spark, lake, onepass.METERED)
    parts = onepass.branches(spark, lake.path("silver_split/metered"), quality.METERED_RULES)
    tip = Measure("tip_amount")
    counts = [
        present(
            tally(rows, ["puYear"], [tip]),
            [F.lit(name).alias("outcome"), F.col("puYear").alias("year")],
            {"trips": F.col("rows__n"), "tips": F.round(exact_sum(tip), 2)},
        )
        for name, rows in ((onepass.KEPT, parts.kept), (onepass.FAILED, parts.dead_letters))
    ]
    return counts[0].unionByName(counts[1])


_OK = f"coalesce({o.METERED_OK}, FALSE)"


@query(
    "v5_u3_observed_report",
    o.sql(
        f"SELECT {o.n()} AS total_rows, {o.countif(_OK)} AS passed_rows, {o.countif(f'NOT {_OK}')} AS failed_rows, "
        + ", ".join(
            f"{o.countif(f'NOT coalesce({test}, FALSE)')} AS failed_{name}"
            for name, test in o.METERED_RULES.items()
        )
        + f", (SELECT {o.n()} FROM silver_redelivered) AS kept_stored, {o.countif(f'NOT {_OK}')} AS failed_stored, "
        f"CAST(0 AS BIGINT) AS undecided_rows, {o.pct(f'COUNT(*) FILTER (WHERE {_OK})', 'COUNT(*)')} AS pass_rate_pct, "
        f"{o.countif(_OK)} - (SELECT {o.n()} FROM silver_redelivered) AS removed_rows FROM redelivered",
        "silver_redelivered",
        "redelivered",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The quality report from the counts that the write itself observed."""
    lake = _lake(spark, adapters.metered_redelivered(spark, sf))
    return onepass.quality_report(spark, onepass.split_job(spark, lake, onepass.METERED))


@query(
    "j6_v15_observed_match",
    o.sql(f"SELECT {o.n()} AS rows, {o.n('weather_temp_c')} AS matched FROM fact", "fact"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    lake = _lake(spark, adapters.metered_bronze(spark, sf))
    onepass.split_job(spark, lake, onepass.METERED)
    lake.write(inputs.hourly(spark, sf), "silver/weather")
    counts = onepass.enrich_job(spark, lake)
    return spark.createDataFrame([(counts["rows"], counts["matched"])], "rows bigint, matched bigint")


# stream ----------------------------------------------------------------------------------


def _streamed(spark: SparkSession, parts: list[DataFrame], delay: str, between=None) -> tuple[str, list[dict]]:
    """The messages of each part land and are drained, one run of the stream after the other."""
    folder, gone = scratch_path(spark, "stream"), []
    for part in parts:
        part.write.mode("append").option("compression", "zstd").parquet(f"{folder}/landing")
        source = readers.message_folder_stream(spark, f"{folder}/landing")
        places = (f"{folder}/silver", f"{folder}/counts", f"{folder}/state")
        try:
            gone.append(stream.drain_silver(source, *places, delay=delay, between=between))
        except Exception as error:
            if "stopped between" not in str(error):
                raise
            gone.append(stream.drain_silver(source, *places, delay=delay))
    return folder, gone


AGAIN = "offset >= 10000000000"
ONCE = "offset < 10000000000"


@query(
    "t1_u1_stream_silver",
    o.sql(
        "SELECT vendor_id, kafka_partition, kafka_offset, payment_type, pickup_hour, is_rush_hour, "
        "fare_amount, tip_amount, " + o.ts("pickup_datetime") + " AS pickup_datetime FROM stream_silver",
        "stream_silver",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Two restarts; messages sent again arrive in the last run and are known by then."""
    messages = adapters.messages(spark, sf)
    even = F.col("partition") % 2 == 0
    parts = [messages.filter(ONCE).filter(even), messages.filter(ONCE).filter(~even), messages.filter(AGAIN)]
    folder, _ = _streamed(spark, parts, "9000 days")
    kept = stream.stored_silver(spark, f"{folder}/silver").kept
    return inputs.texts(kept, "pickup_datetime").select(
        "vendor_id", "kafka_partition", "kafka_offset", "payment_type", "pickup_hour", "is_rush_hour",
        "fare_amount", "tip_amount", "pickup_datetime",
    )


@query(
    "k5_k1_stopped_batch",
    o.sql(
        "SELECT "
        + ", ".join(f"coalesce({test}, FALSE) AS {flag}" for flag, test in o.STREAM_RULES.items())
        + ", " + o.n() + " AS rows FROM stream_trips "
        f"WHERE NOT coalesce({o.STREAM_OK}, FALSE) GROUP BY ALL",
        "stream_trips",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch is stopped between its writes and run again: dead letters are there once."""

    def stop(number: int) -> None:
        if number == 1:
            raise RuntimeError("stopped between two writes")

    messages = adapters.messages(spark, sf)
    folder, _ = _streamed(spark, [messages.filter(ONCE), messages.filter(AGAIN)], "9000 days", stop)
    letters = stream.stored_silver(spark, f"{folder}/silver").dead_letters
    flags = [rule.flag for rule in quality.STREAM_RULES]
    return letters.groupBy(*flags).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "t1_late_messages",
    o.sql(
        f"SELECT (SELECT {o.n()} FROM messages WHERE off < 10000000000 AND dropoff < (SELECT cut FROM edge)) AS late_rows, "
        f"{o.n()} AS missing_rows FROM valid l WHERE dropoff_datetime < (SELECT cut FROM edge) "
        "AND NOT EXISTS (SELECT 1 FROM valid e WHERE e.dropoff_datetime >= (SELECT cut FROM edge) "
        "AND e.pickup_datetime = l.pickup_datetime AND e.pickup_location_id = l.pickup_location_id "
        "AND e.dropoff_location_id = l.dropoff_location_id AND e.fare_amount = l.fare_amount)",
        "stream_trips",
    ).replace(
        "\nSELECT (",
        ", edge AS (SELECT max(dropoff) - to_days(1000) AS cut FROM messages WHERE off < 10000000000), "
        f"valid AS (SELECT * FROM stream_trips WHERE kafka_offset < 10000000000 AND {o.STREAM_OK})\nSELECT (",
        1,
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Old messages land after new ones: the stream counts them as late, the raw table still has them."""
    once = adapters.messages(spark, sf).filter(ONCE)
    edge = once.agg((F.max("timestamp") - F.expr("INTERVAL 1000 DAYS")).alias("cut")).first()["cut"]
    old = F.col("timestamp") < F.lit(edge)
    folder, gone = _streamed(spark, [once.filter(~old), once.filter(old)], "1 day")
    raw = inputs.envelope(spark, sf).filter(F.col("kafka_offset") < 10_000_000_000)
    missing = stream.missing(raw, stream.stored_silver(spark, f"{folder}/silver"))
    return missing.agg(
        F.lit(sum(g["late"] for g in gone)).cast("bigint").alias("late_rows"),
        F.count(F.lit(1)).alias("missing_rows"),
    )


# drops -----------------------------------------------------------------------------------


@query(
    "a2_a6_s14_summaries_by_drop",
    o.sql(
        "SELECT 'month' AS summary, py AS a, pm AS b, "
        f"{o.n()} AS trips, {o.mean('fare')} AS avg_fare, {o.mean('tip')} AS avg_tip, "
        f"{o.mean('distance')} AS avg_distance, {o.total('tot')} AS total_revenue "
        "FROM silver_redelivered GROUP BY py, pm UNION ALL "
        f"SELECT 'hour', {o.HOUR}, CAST({o.WEEKEND} AS INTEGER), "
        f"{o.n()}, {o.mean('fare')}, {o.mean('tip')}, {o.mean('distance')}, NULL "
        "FROM silver_redelivered GROUP BY ALL",
        "silver_redelivered",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Three drops taken in one by one, the last one sent twice; summaries merged from their cells."""
    store = increments.DropStore(Lake(scratch_path(spark, "by-drop")), onepass.METERED)
    once = adapters.metered_bronze(spark, sf, keep={"line": F.col("l_linenumber")})
    again = once.filter("line % 3 = 0").withColumn("tip_amount", F.round(F.col("tip_amount") + 1, 2))
    drops = {
        "early": once.filter("puYear < 1998"),
        "late": once.filter("puYear >= 1998"),
        "sent_again": again,
        "sent_once_more": again,
    }
    missing = F.lit(None).cast("double")
    names = ("weather_temp_c", "weather_wind_kmh", "weather_precip_mm")
    for name, rows in drops.items():
        increments.absorb(
            spark,
            store,
            name,
            rows.drop("line"),
            lambda kept: gold.metered_fact(kept.withColumns(dict.fromkeys(names, missing))),
        )
    clock = summary.cells_of(increments.all_drops(spark, store, "cells"), "clock")
    shown = ["trips", "avg_fare", "avg_tip", "avg_distance"]
    monthly = summary.monthly_metered(clock, tallied=True).select(
        F.lit("month").alias("summary"), F.col("year").alias("a"), F.col("month").alias("b"), *shown, "total_revenue"
    )
    # hour and weekend settle the rush hour, so the groups are the same
    hourly = summary.hourly_summary(clock, tallied=True).select(
        F.lit("hour").alias("summary"),
        F.col("pickup_hour").alias("a"),
        F.col("is_weekend").cast("int").alias("b"),
        *shown,
        F.lit(None).cast("double").alias("total_revenue"),
    )
    return monthly.unionByName(hourly)


# sums ------------------------------------------------------------------------------------

_KIND = "l_linenumber % 4"
_VALUE = (
    f"CASE {_KIND} WHEN 0 THEN l_discount * l_tax / 10 WHEN 1 THEN l_tax * 1e-15 "
    "WHEN 2 THEN l_extendedprice * 1e16 ELSE l_extendedprice / 100 END"
)


def _limb(kind: int, scale: int) -> str:
    exact = f"SUM(TRY_CAST(CAST(v AS VARCHAR) AS DECIMAL(38,{scale}))) FILTER (WHERE kind = {kind})"
    return f"CAST(CAST({exact} AS VARCHAR) AS DOUBLE)"


@query(
    "a2_sums_of_all_sizes",
    "SELECT l_returnflag AS flag, kind, seen, "
    + o.rd("sum / pow(10, floor(log10(sum)))", 12)
    + " AS digits, floor(log10(sum)) AS power FROM ("
    "SELECT l_returnflag, kind, COUNT(v) AS seen, CASE kind "
    f"WHEN 0 THEN {_limb(0, 30)} WHEN 1 THEN {_limb(1, 36)} WHEN 2 THEN {_limb(2, 8)} ELSE {_limb(3, 18)} END AS sum "
    f"FROM (SELECT l_returnflag, CAST({_KIND} AS INTEGER) AS kind, {_VALUE} AS v FROM lineitem) GROUP BY l_returnflag, kind)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Tiny, ordinary and large values: none of them raises, none is rounded before the sum."""
    measure = Measure("v")
    rows = adapters.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.expr(_KIND).cast("int").alias("kind"), F.expr(_VALUE).alias("v")
    )
    sums = present(
        tally(rows, ["flag", "kind"], [measure]),
        ["flag", "kind"],
        {"seen": F.col(measure.seen), "sum": exact_sum(measure), "mean": exact_mean(measure)},
    )
    power = F.floor(F.log10("sum")).cast("double")
    return sums.select("flag", "kind", "seen", F.round(F.col("sum") / F.pow(F.lit(10.0), power), 12).alias("digits"), power.alias("power"))


# days ------------------------------------------------------------------------------------


def _stored_days(spark: SparkSession, sf: str) -> Lake:
    """The fact by drop, its calendar and its day parts. Trips of days that end in 1
    lie in the drop of the month before."""
    lake = Lake(scratch_path(spark, "lake"))
    fact = inputs.metered_fact(spark, sf)
    late = F.col("date_key") % 10 == 1
    month = F.when(late & (F.col("month") > 1), F.col("month") - 1).otherwise(F.col("month"))
    lake.write(fact.withColumn("month", month), "gold/fact_trips_yellow", FACT_PARTITIONS)
    days = adapters.table(spark, sf, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("first_day"),
        F.max("l_shipdate").cast("date").alias("last_day"),
    )
    lake.write(gold.calendar(readers.calendar_days(days)), "gold/dim_time")
    dayparts.day_parts_job(spark, lake, "fact_trips_yellow")
    return lake


@query(
    "j4_weekends_of_a_quarter",
    o.sql(
        f"SELECT year_month, day_name, {o.n()} AS trips, {o.mean('fare_amount')} AS avg_fare "
        "FROM fact f JOIN calendar c USING (date_key) "
        "WHERE c.is_weekend AND c.quarter = 2 AND c.year = 1996 GROUP BY year_month, day_name",
        "fact",
        "calendar",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Trips on chosen days of the calendar, from the partitions that hold those days."""
    lake = _stored_days(spark, sf)
    fare = Measure("fare_amount")
    keys = ["year_month", "day_name"]
    found = dayparts.trips_of_days(
        lake.read(spark, "gold/fact_trips_yellow"),
        lake.read(spark, "gold/fact_trips_yellow_days"),
        lake.read(spark, "gold/dim_time"),
        F.expr("is_weekend AND quarter = 2 AND year = 1996"),
        keys,
        [fare],
    )
    return present(found, keys, {"trips": F.col("rows__n"), "avg_fare": F.round(exact_mean(fare), 2)})
