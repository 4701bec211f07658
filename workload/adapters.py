"""Driver tables as inputs of the trip jobs.

Only this module knows the driver's schemas. Every row of a table takes part;
nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.operators.envelope import encode_payload


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(value: Column) -> Column:
    return F.round(value, 2)


def _computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that filters further up do not recompute.

    Real drops carry these as stored columns; here they are derived, and a plain
    projection would be substituted into every rule that mentions them.
    """
    cells = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(cells)))


def metered_bronze(
    spark: SparkSession, sf_dir: str, keep: dict[str, Column] | None = None
) -> DataFrame:
    """``lineitem`` as metered trips; every fifth-line trip has no passenger count.

    Fares, tips and distances are raw doubles with parts of a cent and of a mile.
    """
    lines = table(spark, sf_dir, "lineitem")
    lines = _computed_once(lines, fare=F.col("l_extendedprice") / 100)
    lines = _computed_once(lines, tip=F.col("fare") * F.col("l_tax"))
    lines = _computed_once(lines, total=F.col("fare") + F.col("tip"))
    hours = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24).cast("int")
    pickup = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), hours)
    dropoff = pickup + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))
    return lines.select(
        (F.col("l_orderkey") % 2 + 1).alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.nullif(F.col("l_linenumber"), F.lit(5)).cast("double").alias("passenger_count"),
        (F.col("l_quantity") + F.col("l_discount") / 8).alias("trip_distance"),
        (F.col("l_linenumber") % 6 + 1).cast("double").alias("RatecodeID"),
        F.col("l_suppkey").alias("PULocationID"),
        (F.col("l_partkey") % 100).alias("DOLocationID"),
        F.when(F.col("l_returnflag") == "A", 1)
        .when(F.col("l_returnflag") == "N", 2)
        .when(F.col("l_linestatus") == "O", 3)
        .otherwise(4)
        .cast("bigint")
        .alias("payment_type"),
        F.col("fare").alias("fare_amount"),
        F.col("tip").alias("tip_amount"),
        F.col("total").alias("total_amount"),
        F.col("l_discount").alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("airport_fee"),
        F.year("l_shipdate").alias("puYear"),
        F.month("l_shipdate").alias("puMonth"),
        *[column.alias(name) for name, column in (keep or {}).items()],
    )


def metered_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metered trips of which every third line was delivered twice, with a larger tip."""
    trips = metered_bronze(spark, sf_dir, keep={"line": F.col("l_linenumber")})
    again = trips.filter(F.col("line") % 3 == 0).withColumn(
        "tip_amount", F.round(F.col("tip_amount") + 1, 2)
    )
    return trips.unionByName(again).drop("line")


def ride_hail_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride-hail trips of which those of the shared kind were delivered twice."""
    trips = ride_hail_bronze(spark, sf_dir)
    again = trips.filter(F.col("shared_request_flag") == "Y").withColumn(
        "tips", F.round(F.col("tips") + 1, 2)
    )
    return trips.unionByName(again)


def ride_hail_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ride-hail trips, moved back in time to overlap the metered fleet."""
    events = _computed_once(
        table(spark, sf_dir, "events"),
        miles=_cents(F.col("value") / 3),
        tips=_cents(F.col("value") * (F.col("event_id") % 5) / 50),
        pay=_cents(F.col("value") * 3 / 4),
    )
    days = (8400 + F.col("event_id") % 6 * 365 + F.col("user_id") % 12 * 30).cast("int")
    pickup = F.col("ts") - F.make_dt_interval(days)
    seconds = F.floor(F.col("value") * 60).cast("bigint")
    licence = (
        F.when(F.col("event_type") == "click", "HV0003")
        .when(F.col("event_type") == "view", "HV0005")
        .when(F.col("event_type") == "purchase", "HV0004")
        .when(F.col("event_type") == "signup", "HV0002")
        .otherwise("HV9999")
    )

    def flag(modulus: int) -> Column:
        return F.when(F.col("event_id") % modulus == 0, "Y").otherwise("N")

    return events.select(
        licence.alias("hvfhs_license_num"),
        pickup.alias("pickup_datetime"),
        (pickup + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("double"))).alias(
            "dropoff_datetime"
        ),
        F.col("user_id").alias("PULocationID"),
        (F.col("event_id") % 300).alias("DOLocationID"),
        F.col("miles").alias("trip_miles"),
        seconds.alias("trip_time"),
        F.col("value").alias("base_passenger_fare"),
        "tips",
        F.col("pay").alias("driver_pay"),
        flag(7).alias("shared_request_flag"),
        flag(21).alias("shared_match_flag"),
        flag(11).alias("wav_request_flag"),
        flag(33).alias("wav_match_flag"),
        F.lit(None).cast("double").alias("airport_fee"),
        F.lit(None).cast("double").alias("congestion_surcharge"),
        F.year(pickup).alias("puYear"),
        F.month(pickup).alias("puMonth"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as zones; some service zones have no borough, as in the real lookup."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("location_id"),
            F.when(F.col("n_nationkey") % 12 != 11, F.col("r_name")).alias("borough"),
            F.col("s_name").alias("zone"),
            F.col("n_name").alias("service_zone"),
        )
    )


def station_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as station reports, with every kind of missing code."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    moment = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (key % 24).cast("int"), (key % 60).cast("int")
    )
    tenths = (F.col("o_custkey") * 7 + key) % 550 - 180
    temperature = (
        F.when(key % 29 == 0, "+9999")
        .when(key % 31 == 0, "nan")
        .when(key % 37 == 0, "")
        .when(tenths < 0, F.concat(F.lit("-"), F.lpad((-tenths).cast("string"), 4, "0")))
        .otherwise(F.concat(F.lit("+"), F.lpad(tenths.cast("string"), 4, "0")))
    )
    wind = F.when(key % 23 == 0, "9999").otherwise(
        F.lpad((F.col("o_custkey") % 180).cast("string"), 4, "0")
    )
    depth = F.when(key % 19 == 0, "9999").otherwise(
        F.lpad((F.when(key % 4 == 0, key % 130).otherwise(0)).cast("string"), 4, "0")
    )
    return orders.select(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"),
        F.concat(temperature, F.lit(",1,N,1")).alias("TMP"),
        F.when(key % 41 == 0, "030,5").otherwise(
            F.concat(F.lit("030,5,N,"), wind, F.lit(",5"))
        ).alias("WND"),
        F.when(key % 17 == 0, None)
        .when(key % 43 == 0, "nan")
        .otherwise(F.concat(F.lit("01,"), depth, F.lit(",2,1")))
        .alias("AA1"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metered trips as topic messages, every third line sent twice.

    Every 17th zone sends text that is not JSON, every 19th a wrong type for one
    field, every 23rd a number JSON does not know, every 29th a bad time.
    """
    line = F.col("l_linenumber")
    keys = {
        "line": line,
        "partition": (F.col("l_suppkey") % 3).cast("int"),
        "offset": F.col("l_orderkey") * 8 + line,
    }
    once = metered_bronze(spark, sf_dir, keep=keys)
    again = once.filter(F.col("line") % 3 == 0).withColumns(
        {
            "tip_amount": F.round(F.col("tip_amount") + 1, 2),
            "offset": F.col("offset") + 10_000_000_000,
        }
    )
    encoded = encode_payload(
        once.unionByName(again),
        stamp=F.date_format("tpep_dropoff_datetime", "yyyy-MM-dd'T'HH:mm:ss"),
        keep=["partition", "offset", "tpep_dropoff_datetime", "PULocationID"],
    )
    zone, payload = F.col("PULocationID"), F.col("raw_json")

    def swapped(field: str, old: str, new: str) -> Column:
        return F.regexp_replace(payload, f'"{field}":{old}', f'"{field}":{new}')

    broken = (
        F.when(zone % 17 == 16, F.concat(F.lit("lost "), payload))
        .when(zone % 19 == 18, swapped("fare_amount", "[0-9.]+", '"n/a"'))
        .when(zone % 23 == 22, swapped("trip_distance", "[0-9.]+", "NaN"))
        .when(zone % 29 == 28, swapped("pickup_datetime", '"[^"]+"', '"NaT"'))
        .otherwise(payload)
    )
    return encoded.select(
        broken.cast("binary").alias("value"),
        "partition",
        "offset",
        F.col("tpep_dropoff_datetime").cast("timestamp").alias("timestamp"),
    )


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as query texts: accepted ones and one family per rule."""
    n = F.col("event_id")
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(n % 13 == 0, F.concat(F.lit("SELECT * FROM fact_trips_yellow LIMIT "), user))
        .when(
            n % 13 == 1,
            F.concat(
                F.lit("```sql\nSELECT z.borough, COUNT(*) AS trips FROM fact_trips_yellow f "),
                F.lit("JOIN dim_zone z ON f.pickup_location_id = z.location_id WHERE z.zone = '"),
                kind,
                F.lit("' GROUP BY z.borough LIMIT 10;\n```"),
            ),
        )
        .when(n % 13 == 2, F.concat(F.lit("  select trips from monthly_trips where year = "), user))
        .when(n % 13 == 3, F.concat(F.lit("DELETE FROM dim_zone WHERE location_id = "), user))
        .when(
            n % 13 == 4,
            F.concat(F.lit("SELECT * FROM dim_time LIMIT 5; DROP TABLE t"), user),
        )
        .when(n % 13 == 5, F.concat(F.lit("SELECT * FROM "), kind, F.lit(" LIMIT 10")))
        .when(n % 13 == 6, F.concat(F.lit("SELECT * FROM zone_summary LIMIT "), F.col("event_id")))
        .when(n % 13 == 7, F.lit("   "))
        .when(n % 13 == 8, F.concat(F.lit("WITH x AS (SELECT 1) SELECT "), user))
        .when(
            n % 13 == 9,
            F.concat(
                F.lit("SELECT EXTRACT(YEAR FROM pickup) FROM hourly_summary WHERE h = "),
                user,
                F.lit(" LIMIT 7"),
            ),
        )
        .when(
            n % 13 == 10,
            F.concat(F.lit("SELECT replace(zone, 'a', '"), kind, F.lit("') FROM dim_zone LIMIT 3")),
        )
        .when(
            n % 13 == 11,
            F.concat(F.lit("SELECT 1 FROM dim_zone LIMIT 2; SELECT "), user, F.lit(";;")),
        )
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("text_id"), text.alias("query_text"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as user questions, some of which hit several routes or none."""
    n = F.col("event_id")
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(n % 11 == 0, F.concat(F.lit("Show yellow taxi trips month by month in 2020, zone "), user))
        .when(n % 11 == 1, F.concat(F.lit("Top 10 pickup zones after a "), kind))
        .when(n % 11 == 2, F.concat(F.lit("Does rain change the tip in zone "), user, F.lit("?")))
        .when(n % 11 == 3, F.concat(F.lit("Which borough had the most revenue from "), kind, F.lit("?")))
        .when(n % 11 == 4, F.concat(F.lit("How do people pay by card for a "), kind, F.lit(" TRAIN ride?")))
        .when(n % 11 == 5, F.concat(F.lit("RUSH HOUR or weekend for user "), user))
        .when(n % 11 == 6, F.concat(F.lit("Average fare per trip by borough "), user))
        .when(n % 11 == 7, F.concat(F.lit("What percentage of trips were rideshare, "), kind))
        .when(n % 11 == 8, F.concat(F.lit("Fastest recovery after covid: zone "), user))
        .when(n % 11 == 9, F.concat(F.lit("Congestion pricing in January 2025 for "), kind))
        .otherwise(F.concat(kind, F.lit(" "), user))
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("question_id"), text.alias("question")
    )
