"""Fixed code tables and bucket labels, with the columns that apply them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faregrid.functions.cleaning import coded

# Licence code to company.
COMPANIES = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}
UNKNOWN_COMPANY = "Unknown"

# Payment code to label.
PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
}
UNKNOWN_PAYMENT = "Unknown"

# Borough to ordinal.
BOROUGH_ORDINALS = {
    "Manhattan": 1,
    "Brooklyn": 2,
    "Queens": 3,
    "Bronx": 4,
    "Staten Island": 5,
}
OTHER_BOROUGH = 6

# Weather condition to expected demand.
DEMAND_TEXTS = {
    "Rain": "Precipitation expected, higher demand likely",
    "Snow": "Severe weather, very high demand",
    "Clear": "Good conditions, normal demand",
}
UNKNOWN_DEMAND = "Unknown conditions"

# Fixed values: (upper bound, label), each bound exclusive; the last label is open.
TEMPERATURE_BUCKETS = (
    (0, "Freezing (<0C)"),
    (10, "Cold (0-10C)"),
    (20, "Mild (10-20C)"),
    (30, "Warm (20-30C)"),
)
HOTTEST = "Hot (>30C)"

# Dry is exactly zero, the other bounds are exclusive.
DRY = "No rain"
RAIN_BUCKETS = (
    (2, "Light rain"),
    (10, "Moderate rain"),
)
WETTEST = "Heavy rain"

# Steps of wind speed in km/h used to compare tips; a parameter of our own.
WIND_BUCKETS = (
    (10, "Calm (<10 km/h)"),
    (20, "Breezy (10-20 km/h)"),
    (40, "Windy (20-40 km/h)"),
)
STRONGEST_WIND = "Strong (>40 km/h)"


def company(licence: Column) -> Column:
    return coded(licence, COMPANIES, UNKNOWN_COMPANY)


def payment_label(code: Column) -> Column:
    return coded(code, PAYMENT_LABELS, UNKNOWN_PAYMENT)


def borough_ordinal(borough: Column, ordinals=BOROUGH_ORDINALS, other: int = OTHER_BOROUGH) -> Column:
    return coded(borough, ordinals, other)


def demand_text(condition: Column) -> Column:
    return coded(condition, DEMAND_TEXTS, UNKNOWN_DEMAND)


def _steps(value: Column, steps, last: str, unmatched: str | None, head: Column | None = None) -> Column:
    out = head
    for bound, label in steps:
        test = value < bound
        out = F.when(test, label) if out is None else out.when(test, label)
    out = out.otherwise(last)
    if unmatched is not None:
        out = F.when(value.isNull(), F.lit(unmatched)).otherwise(out)
    return out


def temperature_bucket(celsius: Column, unmatched: str | None = None) -> Column:
    """Missing temperatures fall into the open top bucket unless ``unmatched`` names one."""
    return _steps(celsius, TEMPERATURE_BUCKETS, HOTTEST, unmatched)


def rain_bucket(millimetres: Column, unmatched: str | None = None) -> Column:
    """Missing rain falls into the open top bucket unless ``unmatched`` names one."""
    return _steps(millimetres, RAIN_BUCKETS, WETTEST, unmatched, head=F.when(millimetres == 0, DRY))


def wind_bucket(kmh: Column, unmatched: str | None = "No reading") -> Column:
    return _steps(kmh, WIND_BUCKETS, STRONGEST_WIND, unmatched)


def weather_condition(millimetres: Column, celsius: Column) -> Column:
    """Snow needs a known temperature at or below freezing; dry hours are clear."""
    return (
        F.when((millimetres > 0) & (celsius <= 0), "Snow")
        .when(millimetres > 0, "Rain")
        .otherwise("Clear")
    )
