"""Decoding of station codes and the hourly summary."""

from __future__ import annotations

from faregrid.operators import weather
from faregrid.sources.readers import STATION_REPORT_SCHEMA

T = "2024-01-01T05:10:00"


def decode(spark, rows, strict=False):
    reports = spark.createDataFrame(rows, STATION_REPORT_SCHEMA)
    step = weather.decode_reports_strict if strict else weather.decode_reports
    return step(reports).collect()


def test_decoded_values(spark):
    row = decode(spark, [(T, "+0072,1,N,1", "030,5,N,0015,5", "01,0012,2,1")])[0]
    assert (row.pickup_date_str, row.pickup_hour) == ("2024-01-01", 5)
    assert (row.weather_temp_c, row.weather_wind_kmh, row.weather_precip_mm) == (7.2, 5.4, 1.2)


def test_missing_codes(spark):
    rows = [
        (T, "+9999,9", "030,5,N,9999,5", "01,9999,2,1"),
        (T, "-9999,9", "030,5", None),
        (T, "nan", "nan", "nan"),
        (T, "", "", ""),
        (T, None, None, "01"),
    ]
    for row in decode(spark, rows):
        assert (row.weather_temp_c, row.weather_wind_kmh, row.weather_precip_mm) == (None, None, 0.0)


def test_reports_without_time_leave(spark):
    rows = [(None, "+0010,1", None, None), ("no date", "+0010,1", None, None)]
    assert decode(spark, rows) == []


def test_strict_profile(spark):
    rows = [
        (T, "+0000,1", "0,0,N,0100,1", "01,0005,1"),
        (T, "+0991,1", None, None),
        (T, "bad,1", None, None),
        (T, "-0050,1", "0,0,N,9999,1", "01,9999,1"),
        (T, "+0100,1", "0,0,N,0834,1", "01,zz,1"),
    ]
    found = decode(spark, rows, strict=True)
    assert [(r.temperature, r.precipitation, r.wind_speed, r.condition) for r in found] == [
        (0.0, 0.5, 36.0, "Snow"),
        (-5.0, 0.0, None, "Clear"),
        (10.0, 0.0, None, "Clear"),
    ]


def test_hour_summaries(spark):
    rows = [
        (T, "+0100,1", "0,0,N,0100,1", "01,0001,1"),
        ("2024-01-01T05:40:00", "-0101,1", "0,0,N,0200,1", "01,0002,1"),
        ("2024-01-01T06:00:00", "+9999,1", None, None),
    ]
    reports = spark.createDataFrame(rows, STATION_REPORT_SCHEMA)
    hours = weather.hourly_weather(weather.decode_reports(reports)).orderBy("pickup_hour").collect()
    assert [tuple(h)[1:] for h in hours] == [(5, -0.1, 72.0, 0.3), (6, None, None, 0.0)]
    strict = weather.hourly_weather_strict(weather.decode_reports_strict(reports)).collect()
    assert [tuple(h) for h in strict] == [("2024-01-01", 5, -0.1, 0.3, 54.0, "Snow")]
