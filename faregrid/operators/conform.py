"""One canonical schema for drops whose physical schemas drift."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The widest type ever seen for each drifting column.
METERED_TYPES: dict[str, T.DataType] = {
    "VendorID": T.LongType(),
    "PULocationID": T.LongType(),
    "DOLocationID": T.LongType(),
    "passenger_count": T.DoubleType(),
    "RatecodeID": T.DoubleType(),
    "airport_fee": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
}
RIDE_HAIL_TYPES: dict[str, T.DataType] = {
    "PULocationID": T.LongType(),
    "DOLocationID": T.LongType(),
    "trip_time": T.LongType(),
    "airport_fee": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
    "wav_match_flag": T.StringType(),
}

# The Parquet scan widens these physical types itself, without a cast afterwards.
SCAN_WIDENS = {
    ("int", "bigint"),
    ("int", "double"),
    ("smallint", "int"),
    ("smallint", "bigint"),
    ("tinyint", "int"),
    ("tinyint", "bigint"),
    ("float", "double"),
}


def conform(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Rename by case, cast the listed columns, add absent ones as typed NULLs.

    Columns that are not listed are kept as they are.
    """
    actual = {c.lower(): c for c in df.columns}
    listed = {name.lower() for name in types}
    columns = [
        (F.col(actual[name.lower()]) if name.lower() in actual else F.lit(None))
        .cast(kind)
        .alias(name)
        for name, kind in types.items()
    ]
    kept = [c for c in df.columns if c.lower() not in listed]
    return df.select(*kept, *columns)


def scan_schema(physical: Iterable[T.StructType], types: Mapping[str, T.DataType]) -> T.StructType:
    """Every column of every drop once, in canonical type where one is listed."""
    fields = {name.lower(): T.StructField(name, kind) for name, kind in types.items()}
    extra: dict[str, T.StructField] = {}
    for schema in physical:
        for field in schema.fields:
            key = field.name.lower()
            if key in fields:
                continue
            known = extra.get(key)
            if known is None:
                extra[key] = T.StructField(field.name, field.dataType)
                continue
            have, new = known.dataType.simpleString(), field.dataType.simpleString()
            if (have, new) in SCAN_WIDENS:
                extra[key] = T.StructField(known.name, field.dataType)
            elif have != new and (new, have) not in SCAN_WIDENS:
                # neither holds the other: text holds both, whichever came first
                extra[key] = T.StructField(known.name, T.StringType())
    return T.StructType([*extra.values(), *fields.values()])


def scan_accepts(physical: T.StructType, wanted: T.StructType) -> bool:
    """Whether one scan with ``wanted`` reads files of ``physical`` without a cast."""
    kinds = {f.name.lower(): f.dataType.simpleString() for f in wanted.fields}
    for field in physical.fields:
        have, want = field.dataType.simpleString(), kinds.get(field.name.lower())
        if want is not None and have != want and (have, want) not in SCAN_WIDENS:
            return False
    return True


def schema_drift(
    spark: SparkSession, schemas: Mapping[str, T.StructType], types: Mapping[str, T.DataType]
) -> DataFrame:
    """Differences of each drop from the registered types, from file footers only."""
    rows = []
    for drop, schema in schemas.items():
        have = {f.name.lower(): f for f in schema.fields}
        for name, kind in types.items():
            field = have.pop(name.lower(), None)
            found = field.dataType.simpleString() if field else None
            if field is None:
                problem = "absent"
            elif found != kind.simpleString():
                problem = "type"
            elif field.name != name:
                problem = "name"
            else:
                continue
            rows.append((drop, name, kind.simpleString(), found, problem))
    fields = "drop string, column string, registered string, found string, difference string"
    return spark.createDataFrame(rows, fields)
