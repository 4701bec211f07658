"""Independent SQL for the registered queries, run by DuckDB on the same tables.

The SQL is written from the definition of each result, not from the Spark code:
plain CTEs over the driver's tables, one string per query.
"""

from __future__ import annotations


def rd(x: str, digits: int = 2) -> str:
    """Decimal rounding of the shortest text of a double (half away from zero)."""
    return f"CAST(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def exact(x: str) -> str:
    """A double as the decimal its shortest text shows; sums of it do not round."""
    return f"CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18))"


def added(x: str) -> str:
    return f"CAST(CAST(SUM({exact(x)}) AS VARCHAR) AS DOUBLE)"


def avg(x: str) -> str:
    return f"({added(x)} / nullif(CAST(COUNT({x}) AS DOUBLE), 0))"


def mean(x: str, digits: int = 2) -> str:
    return rd(avg(x), digits)


def total(x: str, digits: int = 0) -> str:
    return rd(added(x), digits)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def n(x: str = "*") -> str:
    return big(f"COUNT({x})")


def countif(test: str) -> str:
    return big(f"COUNT(*) FILTER (WHERE {test})")


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return rd(f"CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0)", digits)


# raw doubles, with parts of a cent and of a mile
FARE = "(l_extendedprice / 100)"
TIP = f"({FARE} * l_tax)"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTES[name] = (needs, body)


def sql(body: str, *needs: str) -> str:
    """``body`` with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for need in needs:
        visit(need)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{c} AS ({CTES[c][1]})" for c in ordered) + "\n" + body


cte(
    "metered_lines",
    (),
    f"""
    SELECT l_orderkey, l_linenumber,
      l_orderkey % 2 + 1 AS VendorID,
      l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber) % 24 AS INTEGER)) AS pickup,
      l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber) % 24 AS INTEGER))
        + to_minutes(CAST(l_quantity AS INTEGER)) AS dropoff,
      CAST(nullif(l_linenumber, 5) AS DOUBLE) AS passengers,
      l_quantity + l_discount / 8 AS distance,
      CAST(l_linenumber % 6 + 1 AS DOUBLE) AS rate_code,
      l_suppkey AS pu, l_partkey % 100 AS dof,
      CAST(CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2
                WHEN l_linestatus = 'O' THEN 3 ELSE 4 END AS BIGINT) AS pay,
      {FARE} AS fare, {TIP} AS tip, {FARE} + {TIP} AS tot,
      l_discount AS surcharge,
      CAST(year(l_shipdate) AS INTEGER) AS py, CAST(month(l_shipdate) AS INTEGER) AS pm
    FROM lineitem""",
)
METERED_RULES = {
    "valid_fare": "fare BETWEEN 0 AND 500",
    "valid_distance": "distance BETWEEN 0 AND 100",
    "valid_passengers": "passengers BETWEEN 1 AND 6",
    "valid_pickup": "pickup IS NOT NULL",
    "valid_dropoff": "dropoff IS NOT NULL",
    "valid_locations": "(pu BETWEEN 1 AND 265 AND dof BETWEEN 1 AND 265)",
    "valid_total": "tot BETWEEN 0 AND 1000",
}
METERED_OK = " AND ".join(METERED_RULES.values())
DOW = "CAST(dayofweek(pickup) + 1 AS INTEGER)"
HOUR = "CAST(hour(pickup) AS INTEGER)"
WEEKEND = f"({DOW} IN (1, 7))"
RUSH_LAKE = f"({DOW} BETWEEN 2 AND 6 AND ({HOUR} BETWEEN 7 AND 9 OR {HOUR} BETWEEN 16 AND 19))"
RUSH_STREAM = f"({HOUR} BETWEEN 7 AND 9 OR {HOUR} BETWEEN 17 AND 19)"

cte(
    "redelivered",
    ("metered_lines",),
    f"""
    SELECT * FROM metered_lines
    UNION ALL
    SELECT * REPLACE ({rd("tip + 1")} AS tip) FROM metered_lines WHERE l_linenumber % 3 = 0""",
)
# The survivor of a key has the smallest tip, total and dropoff; the rest breaks no tie here.
SURVIVOR_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "tip tot dropoff VendorID passengers distance rate_code pay surcharge py pm".split()
    )
)


def dedup_metered(source: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY pickup, pu, dof, fare ORDER BY {SURVIVOR_ORDER}) AS rn
      FROM {source} WHERE {METERED_OK}) WHERE rn = 1"""


cte("silver", ("metered_lines",), dedup_metered("metered_lines"))
cte("silver_redelivered", ("redelivered",), dedup_metered("redelivered"))
cte(
    "zones",
    (),
    """
    SELECT s_suppkey AS location_id,
      CASE WHEN n_nationkey % 12 <> 11 THEN r_name END AS borough,
      s_name AS zone, n_name AS service_zone
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""",
)
cte(
    "reports",
    (),
    """
    SELECT strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
             + to_minutes(CAST(o_orderkey % 60 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS d,
      CASE WHEN o_orderkey % 29 = 0 THEN '+9999' WHEN o_orderkey % 31 = 0 THEN 'nan'
           WHEN o_orderkey % 37 = 0 THEN ''
           WHEN (o_custkey * 7 + o_orderkey) % 550 < 180
             THEN '-' || lpad(CAST(180 - (o_custkey * 7 + o_orderkey) % 550 AS VARCHAR), 4, '0')
           ELSE '+' || lpad(CAST((o_custkey * 7 + o_orderkey) % 550 - 180 AS VARCHAR), 4, '0')
      END || ',1,N,1' AS tmp,
      CASE WHEN o_orderkey % 41 = 0 THEN '030,5' ELSE '030,5,N,' ||
        CASE WHEN o_orderkey % 23 = 0 THEN '9999'
             ELSE lpad(CAST(o_custkey % 180 AS VARCHAR), 4, '0') END || ',5' END AS wnd,
      CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'nan'
        ELSE '01,' || CASE WHEN o_orderkey % 19 = 0 THEN '9999'
          ELSE lpad(CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 130 ELSE 0 END AS VARCHAR), 4, '0')
          END || ',2,1' END AS aa1
    FROM orders""",
)
_T = "nullif(replace(string_split(tmp, ',')[1], '+', ''), '')"
_W = "string_split(wnd, ',')[4]"
_R = "string_split(aa1, ',')[2]"


def _number(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '-?[0-9]+') THEN CAST({text} AS DOUBLE) END"


cte(
    "decoded",
    ("reports",),
    f"""
    SELECT d AS weather_datetime, d[1:10] AS pickup_date_str,
      CAST(d[12:13] AS INTEGER) AS pickup_hour,
      CASE WHEN {_T} NOT IN ('9999', '-9999') THEN {_number(_T)} / 10 END AS weather_temp_c,
      CASE WHEN {_W} <> '9999' THEN {rd(f"{_number(_W)} / 10 * 3.6::DOUBLE", 1)} END AS weather_wind_kmh,
      coalesce(CASE WHEN {_R} <> '9999' THEN {_number(_R)} / 10 END, 0.0::DOUBLE) AS weather_precip_mm
    FROM reports""",
)
cte(
    "hourly",
    ("decoded",),
    f"""
    SELECT pickup_date_str, pickup_hour,
      {mean("weather_temp_c", 1)} AS weather_temp_c,
      {rd("max(weather_wind_kmh)", 1)} AS weather_wind_kmh,
      {total("weather_precip_mm", 1)} AS weather_precip_mm
    FROM decoded GROUP BY ALL""",
)
CONDITION = (
    "CASE WHEN precipitation > 0 AND temperature <= 0 THEN 'Snow' "
    "WHEN precipitation > 0 THEN 'Rain' ELSE 'Clear' END"
)
cte(
    "decoded_strict",
    ("decoded",),
    f"""
    SELECT pickup_date_str AS date, pickup_hour AS hour, weather_temp_c AS temperature,
      weather_precip_mm AS precipitation,
      CASE WHEN weather_wind_kmh <= 300 THEN weather_wind_kmh END AS wind_speed
    FROM decoded WHERE abs(weather_temp_c) <= 99""",
)
cte(
    "hourly_strict",
    ("decoded_strict",),
    f"""
    SELECT *, {CONDITION} AS condition FROM (
      SELECT date, hour, {mean("temperature", 1)} AS temperature,
        {total("precipitation", 2)} AS precipitation, {mean("wind_speed", 1)} AS wind_speed
      FROM decoded_strict GROUP BY ALL)""",
)


def fact_body(source: str) -> str:
    return f"""
    SELECT CAST(strftime(pickup, '%Y%m%d') AS INTEGER) AS date_key,
      pu AS pickup_location_id, dof AS dropoff_location_id, {HOUR} AS pickup_hour,
      py AS year, pm AS month, distance AS trip_distance, fare AS fare_amount,
      tip AS tip_amount, tot AS total_amount, passengers AS passenger_count,
      pay AS payment_type, rate_code, {WEEKEND} AS is_weekend, {RUSH_LAKE} AS is_rush_hour,
      weather_temp_c, weather_wind_kmh, weather_precip_mm, 'yellow' AS taxi_type
    FROM {source} s LEFT JOIN hourly h
      ON strftime(s.pickup, '%Y-%m-%d') = h.pickup_date_str AND hour(s.pickup) = h.pickup_hour"""


cte("fact", ("silver", "hourly"), fact_body("silver"))

cte(
    "hail",
    (),
    f"""
    SELECT *, CAST(year(pickup) AS INTEGER) AS py, CAST(month(pickup) AS INTEGER) AS pm,
      pickup + to_seconds(secs) AS dropoff
    FROM (
      SELECT event_id,
        CASE event_type WHEN 'click' THEN 'HV0003' WHEN 'view' THEN 'HV0005'
          WHEN 'purchase' THEN 'HV0004' WHEN 'signup' THEN 'HV0002' ELSE 'HV9999' END AS licence,
        ts - to_days(CAST(8400 + event_id % 6 * 365 + user_id % 12 * 30 AS INTEGER)) AS pickup,
        user_id AS pu, event_id % 300 AS dof, {rd("value / 3")} AS miles,
        CAST(floor(value * 60) AS BIGINT) AS secs, value AS fare,
        {rd("value * (event_id % 5) / 50")} AS tips, {rd("value * 3 / 4")} AS pay,
        CASE WHEN event_id % 7 = 0 THEN 'Y' ELSE 'N' END AS shared_request_flag,
        CASE WHEN event_id % 21 = 0 THEN 'Y' ELSE 'N' END AS shared_match_flag,
        CASE WHEN event_id % 11 = 0 THEN 'Y' ELSE 'N' END AS wav_request_flag,
        CASE WHEN event_id % 33 = 0 THEN 'Y' ELSE 'N' END AS wav_match_flag
      FROM events)""",
)
HAIL_RULES = {
    "valid_fare": "fare BETWEEN 0 AND 500",
    "valid_miles": "miles BETWEEN 0 AND 200",
    "valid_time": "secs BETWEEN 0 AND 14400",
    "valid_pickup": "pickup IS NOT NULL",
    "valid_dropoff": "(dropoff IS NOT NULL AND dropoff > TIMESTAMP '1971-01-01')",
    "valid_locations": "(pu BETWEEN 1 AND 265 AND dof BETWEEN 1 AND 265)",
    "valid_driver_pay": "pay BETWEEN 0 AND 500",
}
HAIL_OK = " AND ".join(HAIL_RULES.values())
COMPANY = (
    "CASE licence WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber' "
    "WHEN 'HV0004' THEN 'Via' WHEN 'HV0005' THEN 'Lyft' ELSE 'Unknown' END"
)
HAIL_ORDER = (
    "tips, miles, dropoff, licence, secs, shared_request_flag, shared_match_flag, "
    "wav_request_flag, wav_match_flag, pm"
)


def dedup_hail(source: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY pickup, pu, dof, fare, pay, py ORDER BY {HAIL_ORDER}) AS rn
      FROM {source} WHERE {HAIL_OK}) WHERE rn = 1"""


cte(
    "hail_redelivered",
    ("hail",),
    f"""
    SELECT * FROM hail UNION ALL
    SELECT * REPLACE ({rd("tips + 1")} AS tips) FROM hail WHERE shared_request_flag = 'Y'""",
)
cte("hail_silver", ("hail",), dedup_hail("hail"))
cte("hail_silver_redelivered", ("hail_redelivered",), dedup_hail("hail_redelivered"))
cte(
    "hail_fact",
    ("hail_silver",),
    f"""
    SELECT CAST(strftime(pickup, '%Y%m%d') AS INTEGER) AS date_key, pu AS pickup_location_id,
      dof AS dropoff_location_id, {HOUR} AS pickup_hour, py AS year, pm AS month,
      miles AS trip_distance, fare AS fare_amount, tips AS tip_amount, pay AS driver_pay,
      secs AS trip_time, {COMPANY} AS company, licence AS hvfhs_license_num,
      shared_request_flag, shared_match_flag, wav_request_flag,
      {WEEKEND} AS is_weekend, {RUSH_LAKE} AS is_rush_hour, 'fhvhv' AS taxi_type
    FROM hail_silver""",
)

# stream path -----------------------------------------------------------------------------
cte(
    "messages",
    ("metered_lines",),
    f"""
    SELECT *, CAST(pu % 3 AS INTEGER) AS part, l_orderkey * 8 + l_linenumber AS off FROM metered_lines
    UNION ALL
    SELECT * REPLACE ({rd("tip + 1")} AS tip), CAST(pu % 3 AS INTEGER),
      l_orderkey * 8 + l_linenumber + 10000000000
    FROM metered_lines WHERE l_linenumber % 3 = 0""",
)
LOST = "pu % 17 = 16"
BAD_FARE = "(pu % 17 <> 16 AND pu % 19 = 18)"
BAD_DISTANCE = "(pu % 17 <> 16 AND pu % 19 <> 18 AND pu % 23 = 22)"
BAD_TIME = "(pu % 17 <> 16 AND pu % 19 <> 18 AND pu % 23 <> 22 AND pu % 29 = 28)"


def unless(bad: str, value: str) -> str:
    return f"CASE WHEN NOT ({LOST} OR {bad}) THEN {value} END"


cte(
    "stream_trips",
    ("messages",),
    f"""
    SELECT {unless("FALSE", "CAST(VendorID AS VARCHAR)")} AS vendor_id,
      {unless(BAD_TIME, "pickup")} AS pickup_datetime, {unless("FALSE", "dropoff")} AS dropoff_datetime,
      {unless("FALSE", "CAST(coalesce(passengers, 0) AS INTEGER)")} AS passenger_count,
      {unless(BAD_DISTANCE, "distance")} AS trip_distance,
      {unless("FALSE", "CAST(pu AS INTEGER)")} AS pickup_location_id,
      {unless("FALSE", "CAST(dof AS INTEGER)")} AS dropoff_location_id,
      {unless(BAD_FARE, rd("fare"))} AS fare_amount, {unless("FALSE", rd("tip"))} AS tip_amount,
      {unless("FALSE", rd("tot"))} AS total_amount, {unless("FALSE", "CAST(pay AS INTEGER)")} AS payment_type,
      part AS kafka_partition, off AS kafka_offset
    FROM messages""",
)
STREAM_RULES = {
    "valid_fare": "fare_amount BETWEEN 0 AND 500",
    "valid_distance": "trip_distance BETWEEN 0 AND 100",
    "valid_passengers": "passenger_count BETWEEN 1 AND 6",
    "valid_pickup": "pickup_datetime IS NOT NULL",
    "valid_dropoff": "dropoff_datetime IS NOT NULL",
    "valid_locations": "(pickup_location_id BETWEEN 1 AND 265 AND dropoff_location_id BETWEEN 1 AND 265)",
    "valid_total": "total_amount BETWEEN 0 AND 1000",
}
STREAM_OK = " AND ".join(STREAM_RULES.values())
cte(
    "stream_silver",
    ("stream_trips", "hourly_strict"),
    f"""
    SELECT t.*, {HOUR} AS pickup_hour, CAST(month(pickup) AS INTEGER) AS pickup_month,
      CAST(year(pickup) AS INTEGER) AS pickup_year, {DOW} AS pickup_dow,
      {WEEKEND} AS is_weekend, {RUSH_STREAM} AS is_rush_hour,
      temperature AS weather_temp_c, precipitation AS weather_precip_mm,
      wind_speed AS weather_wind_kmh, condition AS weather_condition
    FROM (SELECT *, pickup_datetime AS pickup FROM (
        SELECT *, row_number() OVER (
          PARTITION BY pickup_datetime, pickup_location_id, dropoff_location_id, fare_amount
          ORDER BY kafka_partition, kafka_offset) AS rn
        FROM stream_trips WHERE {STREAM_OK}) WHERE rn = 1) t
    LEFT JOIN hourly_strict w
      ON strftime(pickup, '%Y-%m-%d') = w.date AND hour(pickup) = w.hour""",
)

# summaries -------------------------------------------------------------------------------
AVERAGES = f"""{n()} AS trips, {mean("fare_amount")} AS avg_fare, {mean("tip_amount")} AS avg_tip,
      {mean("trip_distance")} AS avg_distance"""
TEMP_BUCKET = (
    "CASE WHEN weather_temp_c < 0 THEN 'Freezing (<0C)' WHEN weather_temp_c < 10 THEN 'Cold (0-10C)' "
    "WHEN weather_temp_c < 20 THEN 'Mild (10-20C)' WHEN weather_temp_c < 30 THEN 'Warm (20-30C)' "
    "ELSE 'Hot (>30C)' END"
)
RAIN_BUCKET = (
    "CASE WHEN weather_precip_mm = 0 THEN 'No rain' WHEN weather_precip_mm < 2 THEN 'Light rain' "
    "WHEN weather_precip_mm < 10 THEN 'Moderate rain' ELSE 'Heavy rain' END"
)
WIND_BUCKET = (
    "CASE WHEN weather_wind_kmh IS NULL THEN 'No reading' WHEN weather_wind_kmh < 10 THEN 'Calm (<10 km/h)' "
    "WHEN weather_wind_kmh < 20 THEN 'Breezy (10-20 km/h)' "
    "WHEN weather_wind_kmh < 40 THEN 'Windy (20-40 km/h)' ELSE 'Strong (>40 km/h)' END"
)
PAYMENT = (
    "CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge' "
    "WHEN 4 THEN 'Dispute' ELSE 'Unknown' END"
)
TIP_PCT = rd(f"{avg('tip_amount')} / nullif({avg('fare_amount')}, 0) * 100")
TOTAL_REVENUE = f"{total('total_amount')} AS total_revenue"
FARE_REVENUE = f"{total('fare_amount')} AS total_revenue"

cte(
    "located",
    ("fact", "zones"),
    "SELECT f.*, z.borough, z.zone, z.service_zone FROM fact f JOIN zones z ON f.pickup_location_id = z.location_id",
)
cte(
    "monthly",
    ("fact", "hail_fact"),
    f"""
    SELECT year, month, {AVERAGES}, {TOTAL_REVENUE}, 'Yellow Taxi' AS taxi_type FROM fact GROUP BY year, month
    UNION ALL
    SELECT year, month, {AVERAGES}, {FARE_REVENUE}, company FROM hail_fact GROUP BY year, month, company""",
)
cte(
    "yearly",
    ("fact", "hail_fact"),
    f"""
    SELECT year, {AVERAGES}, {TOTAL_REVENUE}, 'Yellow Taxi' AS taxi_type FROM fact GROUP BY year
    UNION ALL
    SELECT year, {AVERAGES}, {FARE_REVENUE}, company FROM hail_fact GROUP BY year, company""",
)
cte(
    "boroughs",
    ("located",),
    f"SELECT year, borough, {AVERAGES}, {TOTAL_REVENUE}, 'Yellow Taxi' AS taxi_type FROM located GROUP BY year, borough",
)
cte(
    "zone_rollup",
    ("located",),
    f"SELECT zone, borough, service_zone, {AVERAGES}, {TOTAL_REVENUE} FROM located GROUP BY zone, borough, service_zone",
)
cte(
    "hours",
    ("fact",),
    f"""SELECT pickup_hour, is_weekend, is_rush_hour, {AVERAGES}, {TIP_PCT} AS avg_tip_pct
    FROM fact GROUP BY pickup_hour, is_weekend, is_rush_hour""",
)
cte(
    "payments",
    ("fact",),
    f"""SELECT year, payment_type, {AVERAGES}, {TIP_PCT} AS avg_tip_pct, {PAYMENT} AS payment_label
    FROM fact GROUP BY year, payment_type""",
)
cte(
    "weather_rollup",
    ("located",),
    f"""SELECT borough, {TEMP_BUCKET} AS temp_bucket, {RAIN_BUCKET} AS rain_bucket, {AVERAGES}
    FROM located GROUP BY ALL""",
)
cte(
    "quarters",
    ("located",),
    f"""SELECT year, CAST((month + 2) // 3 AS INTEGER) AS quarter, borough, {n()} AS trips,
      {mean("fare_amount")} AS avg_fare, {TOTAL_REVENUE}
    FROM located GROUP BY ALL""",
)
cte(
    "both_facts",
    ("fact", "hail_fact"),
    """SELECT * FROM fact UNION ALL BY NAME SELECT * FROM hail_fact""",
)
cte(
    "calendar",
    (),
    """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  dayname(d) AS day_name, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
  strftime(d, '%Y-%m') AS year_month
FROM (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d
      FROM lineitem)""",
)
