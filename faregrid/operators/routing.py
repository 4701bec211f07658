"""Routing of questions held in a table to the result table that answers them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Route:
    name: str
    table: str
    keywords: tuple[str, ...]


# Routes in their declared order, which also decides ties.
TRIP_ROUTES = (
    Route(
        "covid_monthly",
        "answer_covid_monthly",
        ("covid", "2020", "monthly", "month by month", "pandemic", "lockdown", "decline",
         "collapse"),
    ),
    Route(
        "borough_recovery",
        "answer_borough_recovery",
        ("recovery", "fastest recovery", "bounce back", "q3 2019", "q3 2020",
         "borough recover", "recover after covid"),
    ),
    Route(
        "rideshare_vs_yellow",
        "answer_rideshare_vs_yellow",
        ("rideshare", "uber vs yellow", "yellow vs uber", "market share", "dominance",
         "percentage of trips", "rideshare vs yellow", "uber and yellow"),
    ),
    Route(
        "top_zones",
        "answer_top_zones",
        ("top zones", "pickup zones", "most popular", "busiest zone", "popular pickup",
         "top 10", "top pickup"),
    ),
    Route(
        "weather_impact",
        "answer_weather_impact",
        ("rain", "weather", "precipitation", "rainy", "wet", "storm", "sunny", "dry",
         "umbrella", "temperature", "cold", "warm"),
    ),
    Route(
        "rush_hour",
        "answer_rush_hour",
        ("rush hour", "rush", "peak hour", "peak time", "busy hour", "weekend", "weekday",
         "non-rush"),
    ),
    Route(
        "payment_patterns",
        "answer_payment_patterns",
        ("payment", "credit card", "cash", "tip percentage", "payment type",
         "how people pay", "pay by", "prefer", "driver prefer"),
    ),
    Route(
        "borough_revenue",
        "answer_borough_revenue",
        ("borough revenue", "revenue by borough", "which borough", "most revenue",
         "borough generate", "earn most", "revenue"),
    ),
    Route(
        "congestion_pricing",
        "answer_congestion_pricing",
        ("congestion", "congestion pricing", "2025", "january 2025", "toll",
         "manhattan tax", "congestion charge"),
    ),
    Route(
        "yearly_tips",
        "answer_yearly_tips",
        ("tip", "tipping", "year over year", "yearly", "tip amount", "tip changed",
         "tip trend", "biggest jump", "tip behavior"),
    ),
    Route(
        "borough_fare",
        "borough_summary",
        ("highest fare", "average fare", "fare by borough", "fare per trip", "borough fare",
         "fare 2023", "fare 2019", "fare compare", "fare borough"),
    ),
)


def _hits(text: Column, route: Route, word_boundary: bool) -> Column:
    def hit(keyword: str) -> Column:
        found = text.contains(keyword)
        if word_boundary:  # the pattern only runs where the plain text occurs
            return found & text.rlike(rf"(?U)\b{re.escape(keyword)}\b")
        return found

    return reduce(add, [hit(keyword).cast("int") for keyword in route.keywords])


def route_questions(
    questions: DataFrame,
    column: str,
    routes: tuple[Route, ...] = TRIP_ROUTES,
    word_boundary: bool = False,
) -> DataFrame:
    """Add ``route``, ``target_table`` and ``score`` (NULL route when nothing hits).

    The score of a route is the number of its keywords found in the lower-cased
    text. The keyword table is small and fixed, so it is compiled into the
    expression: no join, no shuffle, whatever the number of questions.
    """
    text = F.lower(F.col(column))
    scored = F.array(
        *[
            F.struct(
                _hits(text, route, word_boundary).alias("score"),
                F.lit(-position).alias("rank"),
                F.lit(route.name).alias("route"),
                F.lit(route.table).alias("target_table"),
            )
            for position, route in enumerate(routes)
        ]
    )
    best = questions.withColumn("__best", F.array_max(scored))
    found = F.col("__best.score") > 0
    return best.select(
        *questions.columns,
        F.when(found, F.col("__best.route")).alias("route"),
        F.when(found, F.col("__best.target_table")).alias("target_table"),
        F.coalesce(F.col("__best.score"), F.lit(0)).alias("score"),
    )
