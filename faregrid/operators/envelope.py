"""Raw message envelope, JSON payload encoding and typed decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faregrid.functions.cleaning import nan_to_null
from faregrid.functions.timeparts import PAYLOAD_TIME_FORMAT, PAYLOAD_TIME_PATTERN

# The twelve fields of a trip message.
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.StringType()),
        T.StructField("pickup_datetime", T.StringType()),
        T.StructField("dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_location_id", T.IntegerType()),
        T.StructField("dropoff_location_id", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("ingestion_timestamp", T.StringType()),
    ]
)

# Columns a message source delivers.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def raw_envelope(messages: DataFrame) -> DataFrame:
    """Keep the payload untouched as text, with its origin and the arrival time."""
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def encode_payload(trips: DataFrame, stamp: Column, keep: list[str] | None = None) -> DataFrame:
    """Metered trips as JSON messages; absent numbers become 0, absent text ''."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    def moment(name: str) -> Column:
        return F.coalesce(F.date_format(name, PAYLOAD_TIME_FORMAT), F.lit(""))

    def number(name: str, kind: str = "double") -> Column:
        return F.coalesce(nan_to_null(F.col(name)).cast(kind), F.lit(0).cast(kind))

    payload = F.struct(
        text("VendorID").alias("vendor_id"),
        moment("tpep_pickup_datetime").alias("pickup_datetime"),
        moment("tpep_dropoff_datetime").alias("dropoff_datetime"),
        number("passenger_count").alias("passenger_count"),
        number("trip_distance").alias("trip_distance"),
        number("PULocationID", "int").alias("pickup_location_id"),
        number("DOLocationID", "int").alias("dropoff_location_id"),
        number("fare_amount").alias("fare_amount"),
        number("tip_amount").alias("tip_amount"),
        number("total_amount").alias("total_amount"),
        number("payment_type", "int").alias("payment_type"),
        stamp.alias("ingestion_timestamp"),
    )
    return trips.select(*(keep or []), F.to_json(payload).alias("raw_json"))


def decode_payload(envelope: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Payload text to typed columns; whatever cannot be read becomes NULL.

    Money is rounded to cents. Missing values are left to the row rules, which
    send such rows to the dead letters. Columns named in ``keep`` are passed on.

    Both steps go through ``inline`` of a one-element array: a filter on the
    typed columns is then not rewritten in terms of the payload, which would
    parse the JSON again for every rule.
    """

    def moment(name: str) -> Column:
        # only the exact format counts; the plain cast alone would take more forms
        text = F.when(F.col(name).rlike(PAYLOAD_TIME_PATTERN), F.col(name))
        return text.try_cast("timestamp_ntz").alias(name)

    def money(name: str) -> Column:
        return F.round(nan_to_null(F.col(name)), 2).alias(name)

    origin = [
        "kafka_partition",
        "kafka_offset",
        *keep,
        F.col("ingestion_timestamp").alias("arrived"),
    ]
    fields = envelope.select(
        *origin, F.inline(F.array(F.from_json("raw_json", PAYLOAD_SCHEMA)))
    )
    typed = F.struct(
        "vendor_id",
        moment("pickup_datetime"),
        moment("dropoff_datetime"),
        nan_to_null(F.col("passenger_count")).try_cast("int").alias("passenger_count"),
        nan_to_null(F.col("trip_distance")).alias("trip_distance"),
        "pickup_location_id",
        "dropoff_location_id",
        money("fare_amount"),
        money("tip_amount"),
        money("total_amount"),
        "payment_type",
    )
    decoded = fields.select(
        F.inline(F.array(typed)), "kafka_partition", "kafka_offset", *keep, "arrived"
    )
    return decoded.withColumnRenamed("arrived", "ingestion_timestamp").withColumn(
        "silver_timestamp", F.current_timestamp()
    )
