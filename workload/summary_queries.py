"""Registered queries over summaries, answers, user questions and texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.functions.measures import EXACT, FARE, TIP, TOTAL
from faregrid.operators import routing, textaudit
from faregrid.operators.lookups import with_zone
from faregrid.operators.tally import tally
from faregrid.plans import answers, gold, jobs, questions, summary
from faregrid.session import scratch_path, staged
from faregrid.sources import catalogue, sinks
from workload import adapters, inputs
from workload import oracle as o
from workload.registry import ORACLES, query

# parameters of the driver's data, where the years run from 1995 to 2001
YEAR = 1998
RECOVERY = (1996, 1998, 2000)
SAME_MONTH = (1, (1997, 1998))
BEFORE, AFTER = (1997, 6), (2001, 11)
YELLOW_ROWS = o.countif("taxi_type = 'yellow'")
HAIL_ROWS = o.countif("taxi_type = 'fhvhv'")


def _metered(spark: SparkSession, sf: str, with_hours: bool = False) -> DataFrame:
    return inputs.metered_fact(spark, sf, with_hours)


# summaries -------------------------------------------------------------------------------


@query("a2_a3_o1_monthly_trips", o.sql("SELECT * FROM monthly", "monthly"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summary.monthly_trips(_metered(spark, sf), inputs.ride_hail_fact(spark, sf))


@query("a4_j3_borough_summary", o.sql("SELECT * FROM boroughs", "boroughs"))
def borough_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary.borough_summary(_metered(spark, sf), adapters.zones(spark, sf))


@query("a5_l1_zone_summary", o.sql("SELECT * FROM zone_rollup", "zone_rollup"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summary.zone_summary(_metered(spark, sf), adapters.zones(spark, sf))


@query("a6_hourly_summary", o.sql("SELECT * FROM hours", "hours"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summary.hourly_summary(_metered(spark, sf))


@query("a7_v13_weather_summary", o.sql("SELECT * FROM weather_rollup", "weather_rollup"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summary.weather_summary(
        _metered(spark, sf, with_hours=True), adapters.zones(spark, sf)
    )


@query(
    "a10_fact_counts",
    o.sql(
        f"SELECT m AS metered_rows, h AS ride_hail_rows, m + h AS combined_rows FROM "
        f"(SELECT {o.n()} AS m FROM fact), (SELECT {o.n()} AS h FROM hail_fact)",
        "fact",
        "hail_fact",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_counts(_metered(spark, sf), inputs.ride_hail_fact(spark, sf))


@query("a11_yearly_summary", o.sql("SELECT * FROM yearly", "yearly"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summary.yearly_summary(_metered(spark, sf), inputs.ride_hail_fact(spark, sf))


@query("a12_p21_payment_summary", o.sql("SELECT * FROM payments", "payments"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summary.payment_summary(_metered(spark, sf))


@query("a13_quarterly_recovery", o.sql("SELECT * FROM quarters", "quarters"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return summary.quarterly_recovery(_metered(spark, sf), adapters.zones(spark, sf))


def _stored_summaries(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All summaries from cells that were written once."""
    cells = staged(summary.summary_cells(_metered(spark, sf, with_hours=True)), "cells")
    hail = staged(summary.ride_hail_cells(inputs.ride_hail_fact(spark, sf)), "hail-cells")
    return summary.all_summaries(cells, hail, staged(adapters.zones(spark, sf), "zones"))


SUMMARY_CTES = {
    "monthly_trips": "monthly",
    "yearly_summary": "yearly",
    "hourly_summary": "hours",
    "payment_summary": "payments",
    "borough_summary": "boroughs",
    "zone_summary": "zone_rollup",
    "quarterly_recovery": "quarters",
    "weather_summary": "weather_rollup",
}


@query(
    "all_summaries_from_cells",
    o.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, {o.n()} AS rows, CAST(SUM(trips) AS BIGINT) AS trips, "
            f"{o.total('avg_fare', 2)} AS fare_sum FROM {source}"
            for name, source in SUMMARY_CTES.items()
        ),
        *SUMMARY_CTES.values(),
    ),
)
def all_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Eight summary tables from two stored cell tables, each checked by three totals."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("trips").alias("trips"),
            F.round(F.sum(F.col("avg_fare").cast(EXACT)).cast("double"), 2).alias("fare_sum"),
        ).select(F.lit(name).alias("table_name"), "rows", "trips", "fare_sum")
        for name, df in _stored_summaries(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _column_sums(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """Rows, values and exact sum of every listed column of every table."""
    parts = []
    for name, wanted in columns.items():
        df = tables[name]
        cells = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(c).alias(f"n_{c}") for c in wanted],
            *[F.sum(F.col(c).cast("double").cast(EXACT)).alias(f"s_{c}") for c in wanted],
        )
        each = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col("rows"),
                F.col(f"n_{c}").alias("filled"),
                F.round(F.col(f"s_{c}").cast("double"), 2).alias("total"),
            )
            for c in wanted
        ]
        parts.append(cells.select(F.inline(F.array(*each))))
    return reduce(DataFrame.unionByName, parts)


def _column_sums_sql(sources: dict[str, str], columns: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, {o.n()} AS rows, {o.n(c)} AS filled, "
        f"{o.total(f'CAST({c} AS DOUBLE)', 2)} AS total FROM {sources[name]}"
        for name, wanted in columns.items()
        for c in wanted
    )


_AVERAGED = ["trips", "avg_fare", "avg_tip", "avg_distance"]
_TRIP_COLUMNS = [
    "pickup_location_id", "dropoff_location_id", "trip_distance", "fare_amount", "tip_amount",
    "pickup_hour", "year", "month",
]
LAKE_COLUMNS = {
    "monthly_trips": [*_AVERAGED, "total_revenue", "month"],
    "yearly_summary": [*_AVERAGED, "total_revenue", "year"],
    "hourly_summary": [*_AVERAGED, "avg_tip_pct", "pickup_hour"],
    "payment_summary": [*_AVERAGED, "avg_tip_pct", "payment_type"],
    "borough_summary": [*_AVERAGED, "total_revenue", "year"],
    "zone_summary": [*_AVERAGED, "total_revenue"],
    "quarterly_recovery": ["trips", "avg_fare", "total_revenue", "quarter"],
    "weather_summary": _AVERAGED,
    "fact_trips_yellow": [
        *_TRIP_COLUMNS, "total_amount", "payment_type", "weather_temp_c", "weather_wind_kmh",
        "weather_precip_mm",
    ],
    "fact_trips_fhvhv": _TRIP_COLUMNS,
    "dim_time": ["date_key", "day_of_week", "week_of_year", "quarter"],
    "dim_zone": ["location_id"],
}
LAKE_SOURCES = SUMMARY_CTES | {
    "fact_trips_yellow": "fact",
    "fact_trips_fhvhv": "hail_fact",
    "dim_time": "calendar",
    "dim_zone": "zones",
}


def _bronze_to_gold(spark: SparkSession, sf: str) -> jobs.Lake:
    """The jobs up to the summaries, each reading the tables of the one before."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    lake.write(adapters.metered_bronze(spark, sf), "bronze/metered", sinks.PARTITIONS)
    lake.write(adapters.ride_hail_bronze(spark, sf), "bronze/ride_hail", sinks.PARTITIONS)
    jobs.weather_job(spark, lake, adapters.station_reports(spark, sf))
    jobs.metered_silver_job(spark, lake)
    jobs.ride_hail_silver_job(spark, lake)
    jobs.enrich_job(spark, lake)
    first, last = (
        adapters.table(spark, sf, "lineitem")
        .agg(*[f("l_shipdate").cast("date").cast("string") for f in (F.min, F.max)])
        .first()
    )
    jobs.gold_job(spark, lake, adapters.zones(spark, sf), first, last)
    jobs.summary_job(spark, lake)
    return lake


@query(
    "k4_k7_lake_jobs_served",
    o.sql(_column_sums_sql(LAKE_SOURCES, LAKE_COLUMNS), *LAKE_SOURCES.values()),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All jobs from bronze to the served views, compared column by column."""
    jobs.serve(spark, _bronze_to_gold(spark, sf))
    return _column_sums({name: spark.table(name) for name in LAKE_COLUMNS}, LAKE_COLUMNS)


@query(
    "k7_marts_as_tables",
    o.sql(
        _column_sums_sql({"mart_boroughs": "boroughs"}, {"mart_boroughs": [*_AVERAGED, "year"]}),
        "boroughs",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A finished model stored as a table of the catalogue, written over and read back."""
    path = scratch_path(spark, "mart")
    for _run in range(2):
        sinks.materialise(borough_summary(spark, sf), "mart_boroughs", "table", path)
    stored = spark.table("mart_boroughs")
    return _column_sums({"mart_boroughs": stored}, {"mart_boroughs": [*_AVERAGED, "year"]})


def _star_checks_sql(zones: str) -> str:
    stream = "stream_silver"
    rules = [
        (table, column, "not_null", f"SELECT {o.countif(f'{column} IS NULL')} AS f FROM {stream}")
        for table in ("stg_silver_trips", "fact_trips")
        for column in ("pickup_datetime", "fare_amount", "pickup_location_id")
    ]
    rules += [
        ("dim_zone", "zone_id", "not_null", f"SELECT {o.countif('location_id IS NULL')} AS f FROM {zones}"),
        ("dim_zone", "zone_id", "unique",
         f"SELECT {o.n()} AS f FROM (SELECT location_id FROM {zones} WHERE location_id IS NOT NULL "
         "GROUP BY ALL HAVING COUNT(*) > 1)"),
        ("dim_time", "pickup_hour", "not_null",
         f"SELECT {o.countif('hour(pickup_datetime) IS NULL')} AS f FROM {stream}"),
        ("dim_weather", "weather_condition", "not_null",
         f"SELECT {o.countif('c IS NULL')} AS f FROM (SELECT DISTINCT weather_condition AS c FROM {stream} "
         "WHERE weather_condition IS NOT NULL)"),
        ("dim_weather", "weather_condition", "accepted_values",
         f"SELECT {o.countif(CONDITION_TEST)} AS f FROM (SELECT DISTINCT "
         f"weather_condition AS c FROM {stream} WHERE weather_condition IS NOT NULL)"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS check_name, f AS failing_rows, "
        f"f = 0 AS passed FROM ({body})"
        for t, c, k, body in rules
    )


CONDITION_TEST = "c NOT IN ('Clear', 'Rain', 'Snow')"
BROKEN_ZONES = (
    "(SELECT location_id FROM zones UNION ALL SELECT location_id FROM zones WHERE location_id % 10 = 3 "
    "UNION ALL SELECT NULL FROM zones WHERE location_id % 25 = 0)"
)


def _star(spark: SparkSession, sf: str, zones: DataFrame) -> DataFrame:
    lake = jobs.Lake(scratch_path(spark, "lake"))
    lake.write(inputs.envelope(spark, sf), "bronze/messages")
    hourly = lake.path("weather.csv")
    sinks.export_csv(inputs.hourly_strict(spark, sf), hourly)
    jobs.stream_silver_job(spark, lake, hourly)
    return jobs.star_job(spark, lake, zones)


@query(
    "v10_v12_star_job_checks",
    o.sql(_star_checks_sql("zones"), "stream_silver", "zones"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Raw messages to the checked star; the checks are counted from the tables."""
    return _star(spark, sf, adapters.zones(spark, sf))


@query(
    "v10_v12_star_job_failures",
    o.sql(_star_checks_sql(BROKEN_ZONES), "stream_silver", "zones"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same job with zones that repeat and zones without an id: both checks fail."""
    zones = adapters.zones(spark, sf)
    twice = zones.filter("location_id % 10 = 3")
    unnamed = zones.filter("location_id % 25 = 0").withColumn(
        "location_id", F.lit(None).cast("bigint")
    )
    return _star(spark, sf, zones.unionByName(twice).unionByName(unnamed))


@query("a7_weather_summary_from_cells", o.sql("SELECT * FROM weather_rollup", "weather_rollup"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_summaries(spark, sf)["weather_summary"]


# answers ---------------------------------------------------------------------------------


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return summary.monthly_metered(_metered(spark, sf))


@query(
    "q1_month_by_month",
    o.sql(
        f"SELECT month, trips, avg_fare FROM monthly WHERE taxi_type = 'Yellow Taxi' AND year = {YEAR}",
        "monthly",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.month_by_month(_monthly(spark, sf), YEAR)


@query(
    "q2_quarter_recovery",
    o.sql(
        "SELECT borough, t0 AS trips_q3_1996, t1 AS trips_q3_1998, t2 AS trips_q3_2000, "
        f"{o.pct('t0 - t1', 't0')} AS pct_drop_1998, {o.pct('t2', 't0')} AS pct_recovery_2000 FROM ("
        "SELECT borough, "
        + ", ".join(
            f"CAST(SUM(trips) FILTER (WHERE year = {y}) AS BIGINT) AS t{i}"
            for i, y in enumerate(RECOVERY)
        )
        + f" FROM quarters WHERE quarter = 3 AND year IN {RECOVERY} GROUP BY borough)",
        "quarters",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    quarterly = summary.quarterly_recovery(_metered(spark, sf), adapters.zones(spark, sf))
    return answers.quarter_recovery(quarterly, 3, RECOVERY)


@query(
    "q3_j5_fleet_share",
    o.sql(
        "SELECT *, yellow_trips + rideshare_trips AS total_trips, "
        + o.pct("rideshare_trips", "yellow_trips + rideshare_trips")
        + " AS rideshare_pct FROM (SELECT year, "
        "CAST(coalesce(SUM(trips) FILTER (WHERE taxi_type = 'Yellow Taxi'), 0) AS BIGINT) AS yellow_trips, "
        "CAST(coalesce(SUM(trips) FILTER (WHERE taxi_type <> 'Yellow Taxi'), 0) AS BIGINT) AS rideshare_trips "
        "FROM yearly GROUP BY year)",
        "yearly",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.fleet_share(
        summary.yearly_summary(_metered(spark, sf), inputs.ride_hail_fact(spark, sf))
    )


@query(
    "q4_l3_top_zones",
    o.sql("SELECT * FROM zone_rollup ORDER BY trips DESC, zone LIMIT 20", "zone_rollup"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    zones = adapters.zones(spark, sf)
    return answers.top_zones(summary.zone_totals(_metered(spark, sf), zones))


@query(
    "q5_weather_impact",
    o.sql(
        "SELECT rain_bucket, CAST(SUM(trips) AS BIGINT) AS total_trips, "
        f"{o.mean('avg_fare')} AS avg_fare, {o.mean('avg_tip')} AS avg_tip "
        "FROM weather_rollup GROUP BY rain_bucket",
        "weather_rollup",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact, zones = _metered(spark, sf, with_hours=True), adapters.zones(spark, sf)
    return answers.weather_impact(summary.weather_summary(fact, zones))


@query(
    "q6_rush_hour",
    o.sql(
        "SELECT is_rush_hour, is_weekend, CAST(SUM(trips) AS BIGINT) AS total_trips, "
        f"{o.mean('avg_fare')} AS avg_fare, {o.mean('avg_tip_pct')} AS avg_tip_pct "
        "FROM hours GROUP BY is_rush_hour, is_weekend",
        "hours",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.rush_hour(summary.hourly_summary(_metered(spark, sf)))


@query(
    "q7_payment_patterns",
    o.sql(
        "SELECT payment_label, CAST(SUM(trips) AS BIGINT) AS total_trips, "
        f"{o.mean('avg_fare')} AS avg_fare, {o.mean('avg_tip_pct')} AS avg_tip_pct "
        "FROM payments GROUP BY payment_label",
        "payments",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.payment_patterns(summary.payment_summary(_metered(spark, sf)))


@query(
    "q8_borough_revenue",
    o.sql(
        "SELECT borough, CAST(SUM(trips) AS BIGINT) AS total_trips, "
        f"SUM(total_revenue) AS total_revenue, {o.mean('avg_fare')} AS avg_fare "
        "FROM boroughs GROUP BY borough",
        "boroughs",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.borough_revenue(borough_summary(spark, sf))


@query(
    "q9_same_month_two_years",
    o.sql(
        "SELECT year, month, taxi_type, trips, avg_fare, avg_tip, avg_distance FROM monthly "
        f"WHERE taxi_type = 'Yellow Taxi' AND month = {SAME_MONTH[0]} AND year IN {SAME_MONTH[1]}",
        "monthly",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.same_month(_monthly(spark, sf), *SAME_MONTH)


@query(
    "q10_yearly_tips",
    o.sql(
        "SELECT year, CAST(SUM(trips) AS BIGINT) AS total_trips, "
        f"{o.mean('avg_tip')} AS avg_tip, {o.mean('avg_fare')} AS avg_fare, "
        + o.rd(f"{o.avg('avg_tip')} / nullif({o.avg('avg_fare')}, 0) * 100", 1)
        + " AS tip_pct FROM monthly WHERE taxi_type = 'Yellow Taxi' GROUP BY year",
        "monthly",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.yearly_tips(_monthly(spark, sf))


WEIGHTED = f"""{o.n()} AS total_trips, {o.mean("fare_amount")} AS trip_avg_fare,
  {o.mean("tip_amount")} AS trip_avg_tip, {o.TIP_PCT} AS trip_tip_pct, {o.TOTAL_REVENUE}"""


@query(
    "q5_rain_trip_weighted",
    o.sql(
        f"SELECT {o.RAIN_BUCKET} AS rain_bucket, {WEIGHTED} FROM fact GROUP BY rain_bucket", "fact"
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.trip_weighted(
        summary.with_buckets(_metered(spark, sf, with_hours=True)), ["rain_bucket"]
    )


@query(
    "q6_rush_hour_trip_weighted",
    o.sql(f"SELECT is_rush_hour, is_weekend, {WEIGHTED} FROM fact GROUP BY 1, 2", "fact"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.trip_weighted(_metered(spark, sf), ["is_rush_hour", "is_weekend"])


@query(
    "q7_payment_trip_weighted",
    o.sql(f"SELECT payment_type, {WEIGHTED} FROM fact GROUP BY payment_type", "fact"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.trip_weighted(_metered(spark, sf), ["payment_type"])


@query(
    "q8_borough_trip_weighted",
    o.sql(f"SELECT borough, {WEIGHTED} FROM located GROUP BY borough", "located"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    measures = (FARE, TIP, TOTAL)
    cells = tally(_metered(spark, sf), ["pickup_location_id"], measures)
    located = with_zone(cells, adapters.zones(spark, sf).select("location_id", "borough"), "pickup")
    return answers.trip_weighted(located, ["borough"], tallied=True)


@query(
    "q10_year_trip_weighted",
    o.sql(f"SELECT year, {WEIGHTED} FROM fact GROUP BY year", "fact"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.trip_weighted(_metered(spark, sf), ["year"])


@query(
    "q11_borough_fare_route",
    o.sql("SELECT * FROM boroughs", "boroughs"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    catalogue.register({"borough_summary": borough_summary(spark, sf)})
    return catalogue.route_result(spark, "borough_summary")


@query(
    "q12_period_collapse",
    o.sql(
        f"SELECT *, {o.pct('trips_before - trips_after', 'trips_before')} AS collapse_pct FROM (SELECT "
        f"{o.countif(f'year = {BEFORE[0]} AND month = {BEFORE[1]}')} AS trips_before, "
        f"{o.countif(f'year = {AFTER[0]} AND month = {AFTER[1]}')} AS trips_after FROM fact)",
        "fact",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return answers.period_collapse(_metered(spark, sf), BEFORE, AFTER)


@query(
    "q13_o2_market_share",
    o.sql(
        f"SELECT *, {o.pct('rideshare_trips', 'yellow_trips + rideshare_trips')} AS rideshare_pct FROM "
        f"(SELECT {YELLOW_ROWS} AS yellow_trips, "
        f"{HAIL_ROWS} AS rideshare_trips "
        f"FROM both_facts WHERE year = {YEAR})",
        "both_facts",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    both = gold.both_facts(_metered(spark, sf), inputs.ride_hail_fact(spark, sf))
    return answers.market_share(both, YEAR)


# user questions --------------------------------------------------------------------------


@query(
    "q14_month_in_two_years",
    o.sql(
        "SELECT borough, trips_1997, trips_1998, "
        + o.pct("trips_1998 - trips_1997", "trips_1997")
        + f" AS change_pct FROM (SELECT borough, {o.countif('year = 1997')} AS trips_1997, "
        f"{o.countif('year = 1998')} AS trips_1998 FROM located "
        "WHERE month = 4 AND year IN (1997, 1998) GROUP BY borough)",
        "located",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.month_in_two_years(
        _metered(spark, sf), adapters.zones(spark, sf), 4, (1997, 1998)
    )


@query(
    "q15_recovery_month",
    o.sql(
        "SELECT b AS base_trips, t AS trough_trips, CAST(min(nr) // 12 AS INTEGER) AS recovery_year, "
        f"CAST(min(nr) % 12 + 1 AS INTEGER) AS recovery_month, "
        f"CAST(min(nr) - {1997 * 12 + 1} AS INTEGER) AS months_taken FROM "
        "(SELECT max(trips) FILTER (WHERE year = 1997 AND month = 1) AS b, "
        "max(trips) FILTER (WHERE year = 1997 AND month = 2) AS t "
        "FROM monthly WHERE taxi_type = 'Yellow Taxi') x LEFT JOIN "
        "(SELECT year * 12 + month - 1 AS nr, trips FROM monthly WHERE taxi_type = 'Yellow Taxi') m "
        f"ON nr >= {1997 * 12 + 1} AND trips >= b * 1.05 GROUP BY b, t",
        "monthly",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.recovery_month(_metered(spark, sf), (1997, 1), (1997, 2), 1.05)


@query(
    "q16_operator_trips_by_year",
    o.sql(
        "SELECT year, "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE coalesce(company, taxi_type) = '{c}')::BIGINT AS {c.lower()}_trips"
            for c in ("Uber", "Lyft", "yellow")
        )
        + " FROM both_facts WHERE coalesce(company, taxi_type) IN ('Uber', 'Lyft', 'yellow') GROUP BY year",
        "both_facts",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    both = gold.both_facts(_metered(spark, sf), inputs.ride_hail_fact(spark, sf))
    return questions.operator_trips_by_year(both, ("Uber", "Lyft", "yellow"))


@query(
    "q17_busiest_company",
    o.sql(
        f"SELECT company, {o.n()} AS trips FROM hail_fact WHERE year = {YEAR} "
        "GROUP BY company ORDER BY trips DESC, company LIMIT 1",
        "hail_fact",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.busiest_company(inputs.ride_hail_fact(spark, sf), YEAR)


@query(
    "q18_rainy_or_dry",
    o.sql(
        "SELECT CASE WHEN weather_precip_mm IS NULL THEN 'No reading' ELSE "
        f"{o.RAIN_BUCKET} END AS rain_bucket, {o.n()} AS trips, {o.mean('fare_amount')} AS avg_fare "
        "FROM fact GROUP BY 1",
        "fact",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.rainy_or_dry(_metered(spark, sf, with_hours=True))


@query(
    "q19_cold_or_warm",
    o.sql(
        "SELECT CASE WHEN weather_temp_c IS NULL THEN 'No reading' ELSE "
        f"{o.TEMP_BUCKET} END AS temp_bucket, {o.n()} AS trips, {o.mean('fare_amount')} AS avg_fare "
        "FROM located WHERE borough = 'ASIA' GROUP BY 1",
        "located",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    fact, zones = _metered(spark, sf, with_hours=True), adapters.zones(spark, sf)
    return questions.cold_or_warm(fact, zones, "ASIA")


@query(
    "q20_tips_by_wind",
    o.sql(
        f"SELECT {o.WIND_BUCKET} AS wind_bucket, {o.n()} AS trips, {o.mean('tip_amount')} AS avg_tip "
        "FROM fact GROUP BY 1",
        "fact",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.tips_by_wind(_metered(spark, sf, with_hours=True))


@query(
    "q21_top_zones_of_borough",
    o.sql(
        f"SELECT zone, {o.n()} AS trips FROM located WHERE borough = 'EUROPE' "
        "GROUP BY zone ORDER BY trips DESC, zone LIMIT 10",
        "located",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.top_zones_of_borough(
        _metered(spark, sf), adapters.zones(spark, sf), "EUROPE"
    )


@query(
    "q22_distance_of_two_zones",
    o.sql(
        f"SELECT zone, {o.n()} AS trips, {o.mean('trip_distance', 2)} AS avg_distance FROM located "
        "WHERE zone IN ('Supplier#000000007', 'Supplier#000000009') GROUP BY zone",
        "located",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    names = ("Supplier#000000007", "Supplier#000000009")
    return questions.distance_of_zones(_metered(spark, sf), adapters.zones(spark, sf), names)


@query(
    "q23_busiest_borough_of_month",
    o.sql(
        f"SELECT borough, {o.n()} AS trips FROM located WHERE year = {YEAR} AND month = 4 "
        "GROUP BY borough ORDER BY trips DESC, borough NULLS FIRST LIMIT 1",
        "located",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.busiest_borough(_metered(spark, sf), adapters.zones(spark, sf), YEAR, 4)


@query(
    "q24_weekend_hours",
    o.sql(
        f"SELECT pickup_hour, {o.n()} AS trips FROM fact WHERE is_weekend GROUP BY pickup_hour", "fact"
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return questions.weekend_hours(_metered(spark, sf))


@query(
    "l2_l4_capped_listing",
    o.sql(
        f"SELECT pickup_location_id, month, {o.n()} AS trips FROM fact "
        "GROUP BY ALL ORDER BY pickup_location_id, month LIMIT 700",
        "fact",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    counts = (
        _metered(spark, sf)
        .groupBy("pickup_location_id", "month")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    return catalogue.limited(counts.orderBy("pickup_location_id", "month"), 700)


# query surface and texts -----------------------------------------------------------------

READ_ONLY_TEXT = """
SELECT z.borough, f.year, COUNT(*) AS trips, MAX(f.passenger_count) AS most_passengers
FROM fact_trips_yellow f
JOIN dim_zone z ON f.pickup_location_id = z.location_id
WHERE f.year IN (1997, 1998) AND f.is_weekend
GROUP BY z.borough, f.year
LIMIT 1000;
"""


@query(
    "x1_read_only_sql",
    o.sql(
        f"SELECT borough, year, {o.n()} AS trips, max(passenger_count) AS most_passengers FROM located "
        "WHERE year IN (1997, 1998) AND is_weekend GROUP BY borough, year",
        "located",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    catalogue.register(
        {"fact_trips_yellow": _metered(spark, sf), "dim_zone": adapters.zones(spark, sf)}
    )
    return catalogue.read_only_sql(spark, READ_ONLY_TEXT)


UNION_TEXT = """```sql
SELECT taxi_type, year, COUNT(*) AS trips FROM fact_trips_yellow GROUP BY taxi_type, year
UNION ALL
SELECT taxi_type, year, COUNT(*) AS trips FROM fact_trips_fhvhv GROUP BY taxi_type, year
```"""


@query(
    "x1_union_of_facts",
    o.sql(f"SELECT taxi_type, year, {o.n()} AS trips FROM both_facts GROUP BY ALL", "both_facts"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    catalogue.register(
        {
            "fact_trips_yellow": _metered(spark, sf),
            "fact_trips_fhvhv": inputs.ride_hail_fact(spark, sf),
        }
    )
    return catalogue.read_only_sql(spark, UNION_TEXT)


QUERY_TEXTS = """
SELECT event_id AS text_id, CASE event_id % 13
  WHEN 0 THEN 'SELECT * FROM fact_trips_yellow LIMIT ' || user_id
  WHEN 1 THEN '```sql' || chr(10) || 'SELECT z.borough, COUNT(*) AS trips FROM fact_trips_yellow f '
    || 'JOIN dim_zone z ON f.pickup_location_id = z.location_id WHERE z.zone = ''' || event_type
    || ''' GROUP BY z.borough LIMIT 10;' || chr(10) || '```'
  WHEN 2 THEN '  select trips from monthly_trips where year = ' || user_id
  WHEN 3 THEN 'DELETE FROM dim_zone WHERE location_id = ' || user_id
  WHEN 4 THEN 'SELECT * FROM dim_time LIMIT 5; DROP TABLE t' || user_id
  WHEN 5 THEN 'SELECT * FROM ' || event_type || ' LIMIT 10'
  WHEN 6 THEN 'SELECT * FROM zone_summary LIMIT ' || event_id
  WHEN 7 THEN '   '
  WHEN 8 THEN 'WITH x AS (SELECT 1) SELECT ' || user_id
  WHEN 9 THEN 'SELECT EXTRACT(YEAR FROM pickup) FROM hourly_summary WHERE h = ' || user_id || ' LIMIT 7'
  WHEN 10 THEN 'SELECT replace(zone, ''a'', ''' || event_type || ''') FROM dim_zone LIMIT 3'
  WHEN 11 THEN 'SELECT 1 FROM dim_zone LIMIT 2; SELECT ' || user_id || ';;'
  ELSE props END AS query_text
FROM events"""
o.cte("query_texts", (), QUERY_TEXTS)
o.cte(
    "cleaned",
    ("query_texts",),
    r"""
    SELECT *, CASE WHEN contains(upper(sanitised), 'LIMIT') THEN sanitised
      ELSE trim(rtrim(sanitised, ';')) || ' LIMIT 100' END AS limited
    FROM (SELECT *, rtrim(regexp_replace(regexp_replace(
        regexp_replace(query_text, '```sql\s*', '', 'gi'), '```\s*', '', 'g'),
        '^\s+|\s+$', '', 'g'), ';') AS sanitised FROM query_texts)""",
)

WORDS = " ".join(textaudit.FORBIDDEN_WORDS)
FEW_WORDS = " ".join(textaudit.FORBIDDEN_WORDS_REDUCED)
KNOWN = "[" + ", ".join(f"'{t}'" for t in textaudit.GUARDED_TABLES) + "]"


def _rule_sql(text: str, words: str, tables: bool = True, single: bool = True) -> str:
    upper = f"upper(trim({text}, ' ' || chr(9) || chr(10) || chr(13)))"
    word = "|".join(words.split())
    limit = rf"TRY_CAST(nullif(regexp_extract({upper}, '\bLIMIT\s+(\d+)', 1), '') AS HUGEINT)"
    named = rf"regexp_extract_all({upper}, '\b(?:FROM|JOIN)\s+([a-zA-Z_][a-zA-Z0-9_]*)', 1)"
    unknown = f"len(list_filter({named}, lambda t: NOT list_contains({KNOWN}, lower(t)))) > 0"
    return (
        f"CASE WHEN {text} IS NULL OR {upper} = '' THEN 'empty' "
        f"WHEN NOT starts_with({upper}, 'SELECT') THEN 'select_only' "
        rf"WHEN regexp_matches({upper}, '\b({word})\b') THEN 'forbidden_word' "
        + (f"WHEN {unknown} THEN 'unknown_table' " if tables else "")
        + f"WHEN NOT contains({upper}, 'LIMIT') THEN 'no_limit' "
        f"WHEN {limit} > 1000 THEN 'limit_too_high' "
        + (f"WHEN contains(rtrim({upper}, ';'), ';') THEN 'multiple_statements' " if single else "")
        + "END"
    )


@query(
    "x2_x4_query_audit",
    o.sql(
        "SELECT *, rule IS NULL AS valid FROM (SELECT text_id, query_text, sanitised, limited, "
        + _rule_sql("limited", WORDS)
        + " AS rule FROM cleaned)",
        "cleaned",
    ),
)
def query_audit(spark: SparkSession, sf: str) -> DataFrame:
    return textaudit.audit(adapters.query_texts(spark, sf), "query_text").drop("error")


@query(
    "x2_validate_as_written",
    o.sql(
        "SELECT *, rule IS NULL AS valid FROM (SELECT text_id, "
        + _rule_sql("query_text", WORDS)
        + " AS rule FROM query_texts)",
        "query_texts",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    checked = textaudit.validate(adapters.query_texts(spark, sf), "query_text")
    return checked.drop("query_text", "error")


@query(
    "x2_reduced_guard",
    o.sql(
        "SELECT rule, " + o.n() + " AS texts FROM (SELECT "
        + _rule_sql("query_text", FEW_WORDS, tables=False, single=False)
        + " AS rule FROM query_texts) GROUP BY rule",
        "query_texts",
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    texts = adapters.query_texts(spark, sf)
    checked = textaudit.validate(texts, "query_text", textaudit.REDUCED_GUARD)
    return checked.groupBy("rule").agg(F.count(F.lit(1)).alias("texts"))


SHAPED_DOCUMENTS = """
SELECT CASE doc_id % 8
  WHEN 0 THEN 'SELECT ''' || text || ''' FROM dim_zone LIMIT 5'
  WHEN 1 THEN text
  WHEN 2 THEN 'SELECT * FROM ' || source || ' WHERE t = ''' || text || ''' LIMIT 3'
  WHEN 3 THEN 'SELECT drop FROM dim_zone -- ' || text
  WHEN 4 THEN 'SELECT zone FROM dim_zone -- ' || text
  WHEN 5 THEN 'SELECT zone FROM dim_zone LIMIT ' || (1001 + n_chars) || ' -- ' || text
  WHEN 6 THEN 'SELECT 1 FROM dim_zone LIMIT 2; SELECT ''' || text || ''''
  ELSE ' ' END AS text FROM documents"""


@query(
    "x2_documents_audit",
    "SELECT rule, " + o.n() + " AS texts FROM (SELECT " + _rule_sql("text", WORDS)
    + f" AS rule FROM ({SHAPED_DOCUMENTS})) GROUP BY rule",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents wrapped into query texts, so that every rule meets some."""
    text, quote = F.col("text"), F.lit("'")
    shaped = (
        F.when(F.col("doc_id") % 8 == 0, F.concat(F.lit("SELECT '"), text, F.lit("' FROM dim_zone LIMIT 5")))
        .when(F.col("doc_id") % 8 == 1, text)
        .when(
            F.col("doc_id") % 8 == 2,
            F.concat(F.lit("SELECT * FROM "), "source", F.lit(" WHERE t = '"), text, F.lit("' LIMIT 3")),
        )
        .when(F.col("doc_id") % 8 == 3, F.concat(F.lit("SELECT drop FROM dim_zone -- "), text))
        .when(F.col("doc_id") % 8 == 4, F.concat(F.lit("SELECT zone FROM dim_zone -- "), text))
        .when(
            F.col("doc_id") % 8 == 5,
            F.concat(
                F.lit("SELECT zone FROM dim_zone LIMIT "), F.col("n_chars") + 1001, F.lit(" -- "), text
            ),
        )
        .when(
            F.col("doc_id") % 8 == 6,
            F.concat(F.lit("SELECT 1 FROM dim_zone LIMIT 2; SELECT '"), text, quote),
        )
        .otherwise(" ")
    )
    documents = adapters.table(spark, sf, "documents").select(shaped.alias("text"))
    checked = textaudit.validate(documents, "text")
    return checked.groupBy("rule").agg(F.count(F.lit(1)).alias("texts"))


QUESTIONS = """
SELECT event_id AS question_id, CASE event_id % 11
  WHEN 0 THEN 'Show yellow taxi trips month by month in 2020, zone ' || user_id
  WHEN 1 THEN 'Top 10 pickup zones after a ' || event_type
  WHEN 2 THEN 'Does rain change the tip in zone ' || user_id || '?'
  WHEN 3 THEN 'Which borough had the most revenue from ' || event_type || '?'
  WHEN 4 THEN 'How do people pay by card for a ' || event_type || ' TRAIN ride?'
  WHEN 5 THEN 'RUSH HOUR or weekend for user ' || user_id
  WHEN 6 THEN 'Average fare per trip by borough ' || user_id
  WHEN 7 THEN 'What percentage of trips were rideshare, ' || event_type
  WHEN 8 THEN 'Fastest recovery after covid: zone ' || user_id
  WHEN 9 THEN 'Congestion pricing in January 2025 for ' || event_type
  ELSE event_type || ' ' || user_id END AS question
FROM events"""
o.cte("questions", (), QUESTIONS)


def _route_sql(routes, source: str, key: str, text: str, word: bool = False) -> str:
    """Score by a keyword table joined on containment, then the best route per text."""
    rows = ", ".join(
        f"({position}, '{r.name}', '{r.table}', '{k}')"
        for position, r in enumerate(routes)
        for k in r.keywords
    )
    test = (
        rf"regexp_matches(lower({text}), '\b' || keyword || '\b')"
        if word
        else f"contains(lower({text}), keyword)"
    )
    return f"""
    , keywords(position, route, target_table, keyword) AS (VALUES {rows}),
    scores AS (SELECT {key} AS k, position, route, target_table, COUNT(*) AS score
      FROM {source} JOIN keywords ON {test} GROUP BY ALL),
    best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, position) = 1)
    SELECT {key}, route, target_table, CAST(coalesce(score, 0) AS INTEGER) AS score
    FROM {source} LEFT JOIN best ON {key} = k"""


QUESTIONS_WITH = f"WITH questions AS ({QUESTIONS})"


@query(
    "x5_route_questions",
    QUESTIONS_WITH + _route_sql(routing.TRIP_ROUTES, "questions", "question_id", "question"),
)
def route_questions(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_questions(adapters.questions(spark, sf), "question").drop("question")


@query(
    "x5_route_by_words",
    QUESTIONS_WITH
    + _route_sql(routing.TRIP_ROUTES, "questions", "question_id", "question", word=True),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    routed = routing.route_questions(
        adapters.questions(spark, sf), "question", word_boundary=True
    )
    return routed.drop("question")


LANGUAGE_ROUTES = (
    routing.Route("english", "en", ("the ", " and ", "ing ", "that ")),
    routing.Route("german", "de", ("und ", " der ", "lich", "sch")),
    routing.Route("french", "fr", (" le ", "que ", "tion", " et ")),
    routing.Route("mail", "contact", ("@", "http")),
)


@query(
    "x5_route_documents",
    "WITH texts AS (SELECT doc_id, text FROM documents)"
    + _route_sql(LANGUAGE_ROUTES, "texts", "doc_id", "text"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts of any length against a keyword table of another subject."""
    documents = adapters.table(spark, sf, "documents").select("doc_id", "text")
    return routing.route_questions(documents, "text", LANGUAGE_ROUTES).drop("text")


@query(
    "x5_route_conversations",
    "WITH texts AS (SELECT conv_id * 100000 + turn AS turn_id, text FROM conversations)"
    + _route_sql(LANGUAGE_ROUTES, "texts", "turn_id", "text"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    turns = adapters.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 100000 + F.col("turn")).alias("turn_id"), "text"
    )
    return routing.route_questions(turns, "text", LANGUAGE_ROUTES).drop("text")


# questions to rows ------------------------------------------------------------------------

ANSWER_COLUMNS = {
    "answer_covid_monthly": ["month", "trips", "avg_fare"],
    "answer_borough_recovery": [
        f"trips_q3_{RECOVERY[0]}", f"trips_q3_{RECOVERY[1]}", f"trips_q3_{RECOVERY[2]}",
        f"pct_drop_{RECOVERY[1]}", f"pct_recovery_{RECOVERY[2]}",
    ],
    "answer_rideshare_vs_yellow": ["year", "yellow_trips", "rideshare_trips", "rideshare_pct"],
    "answer_top_zones": ["trips", "avg_fare", "avg_tip", "total_revenue"],
    "answer_weather_impact": ["total_trips", "avg_fare", "avg_tip"],
    "answer_rush_hour": ["total_trips", "avg_fare", "avg_tip_pct"],
    "answer_payment_patterns": ["total_trips", "avg_fare", "avg_tip_pct"],
    "answer_borough_revenue": ["total_trips", "total_revenue", "avg_fare"],
    "answer_congestion_pricing": ["year", "month", "trips", "avg_fare", "avg_tip", "avg_distance"],
    "answer_yearly_tips": ["year", "total_trips", "avg_tip", "avg_fare", "tip_pct"],
}
ANSWER_SQL = {
    "answer_covid_monthly": "q1_month_by_month",
    "answer_borough_recovery": "q2_quarter_recovery",
    "answer_rideshare_vs_yellow": "q3_j5_fleet_share",
    "answer_top_zones": "q4_l3_top_zones",
    "answer_weather_impact": "q5_weather_impact",
    "answer_rush_hour": "q6_rush_hour",
    "answer_payment_patterns": "q7_payment_patterns",
    "answer_borough_revenue": "q8_borough_revenue",
    "answer_congestion_pricing": "q9_same_month_two_years",
    "answer_yearly_tips": "q10_yearly_tips",
    "borough_summary": "q11_borough_fare_route",
}
ANSWER_SOURCES = {name: f"({ORACLES[sql]})" for name, sql in ANSWER_SQL.items()}


def _answered(spark: SparkSession, sf: str) -> None:
    """Gold tables, summaries and answers stored and served as views."""
    lake = jobs.Lake(scratch_path(spark, "lake"))
    lake.write(_metered(spark, sf, with_hours=True), "gold/fact_trips_yellow")
    lake.write(inputs.ride_hail_fact(spark, sf), "gold/fact_trips_fhvhv")
    lake.write(adapters.zones(spark, sf), "gold/dim_zone")
    jobs.summary_job(spark, lake)
    jobs.answer_job(
        spark,
        lake,
        year=YEAR,
        recovery=RECOVERY,
        quarter=3,
        pricing_month=SAME_MONTH[0],
        pricing_years=SAME_MONTH[1],
    )
    jobs.serve(spark, lake)


@query("k4_answer_tables_stored", _column_sums_sql(ANSWER_SOURCES, ANSWER_COLUMNS))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Ten answer tables written by their job and read back as served, column by column."""
    _answered(spark, sf)
    return _column_sums({name: spark.table(name) for name in ANSWER_COLUMNS}, ANSWER_COLUMNS)


@query(
    "x5_x6_x7_routed_questions",
    "SELECT target_table, questions, rows FROM (SELECT target_table, " + o.n() + " AS questions FROM ("
    + QUESTIONS_WITH
    + _route_sql(routing.TRIP_ROUTES, "questions", "question_id", "question")
    + ") GROUP BY target_table) LEFT JOIN ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS target_table, {o.n()} AS rows FROM {source}"
        for name, source in ANSWER_SOURCES.items()
    )
    + ") USING (target_table)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Each question to its table, and what it gets from the served one."""
    _answered(spark, sf)
    routed = routing.route_questions(adapters.questions(spark, sf), "question")
    targets = {r.table: catalogue.route_result(spark, r.table) for r in routing.TRIP_ROUTES}
    return catalogue.route_counts(routed, targets)
