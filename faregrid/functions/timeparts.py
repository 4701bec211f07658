"""Calendar and clock features of a timestamp."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Day numbers are 1 = Sunday ... 7 = Saturday.
WEEKEND_DAYS = (1, 7)
FIRST_WEEKDAY, LAST_WEEKDAY = 2, 6

DATE_KEY_FORMAT = "yyyyMMdd"
DATE_TEXT_FORMAT = "yyyy-MM-dd"
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
PAYLOAD_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"

# Inclusive hour ranges of the named parts of a day.
DAY_PARTS = (("Morning", 6, 11), ("Afternoon", 12, 16), ("Evening", 17, 20))
REST_OF_DAY = "Night"


@dataclass(frozen=True)
class RushHours:
    """Peak periods: inclusive hour ranges, on weekdays only or on any day."""

    hours: tuple[tuple[int, int], ...]
    weekdays_only: bool
    missing: bool | None


# The two profiles disagree on the evening start and on weekends.
STREAM_RUSH = RushHours(hours=((7, 9), (17, 19)), weekdays_only=False, missing=False)
LAKE_RUSH = RushHours(hours=((7, 9), (16, 19)), weekdays_only=True, missing=None)


def rush_hour(hour: Column, day_of_week: Column, profile: RushHours) -> Column:
    peak = F.lit(False)
    for first, last in profile.hours:
        peak = peak | hour.between(first, last)
    if profile.weekdays_only:
        peak = day_of_week.between(FIRST_WEEKDAY, LAST_WEEKDAY) & peak
    if profile.missing is not None:
        peak = F.coalesce(peak, F.lit(profile.missing))
    return peak


def weekend(day_of_week: Column, profile: RushHours) -> Column:
    flag = day_of_week.isin(*WEEKEND_DAYS)
    return flag if profile.missing is None else F.coalesce(flag, F.lit(profile.missing))


def with_time_features(df: DataFrame, pickup: str, profile: RushHours) -> DataFrame:
    """Hour, month, year, day of week, weekend and rush-hour flag of ``pickup``."""
    moment = F.col(pickup)
    return df.withColumns(
        {
            "pickup_hour": F.hour(moment),
            "pickup_month": F.month(moment),
            "pickup_year": F.year(moment),
            "pickup_dow": F.dayofweek(moment),
        }
    ).withColumns(
        {
            "is_weekend": weekend(F.col("pickup_dow"), profile),
            "is_rush_hour": rush_hour(F.col("pickup_hour"), F.col("pickup_dow"), profile),
        }
    )


def date_text(moment: Column) -> Column:
    return F.date_format(moment, DATE_TEXT_FORMAT)


def date_key(moment: Column) -> Column:
    """``yyyyMMdd`` as an integer, by arithmetic instead of text formatting."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def month_name(month: Column) -> Column:
    """English month name of a month number; NULL outside 1-12."""
    first_of_month = F.make_date(F.lit(2000), F.when(month.between(1, 12), month), F.lit(1))
    return F.date_format(first_of_month, "MMMM")


def part_of_day(hour: Column) -> Column:
    out = None
    for label, first, last in DAY_PARTS:
        test = hour.between(first, last)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(REST_OF_DAY)
