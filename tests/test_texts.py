"""Query-text audit and question routing against plain per-text brute force."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faregrid.operators import routing, textaudit

CASES = [
    # text, accepted, rule
    ("SELECT * FROM dim_zone LIMIT 5", True, None),
    ("select zone from dim_zone limit 5", True, None),
    ("insert into dim_zone values (1)", False, "select_only"),
    ("UPDATE dim_zone SET zone = 'x'", False, "select_only"),
    ("delete from dim_zone", False, "select_only"),
    ("drop table dim_zone", False, "select_only"),
    ("create table t as select 1", False, "select_only"),
    ("SELECT 1 FROM dim_zone; DROP TABLE x LIMIT 1", False, "forbidden_word"),
    ("SELECT dropped FROM dim_zone LIMIT 1", True, None),
    ("SELECT company FROM fact_trips_fhvhv GROUP BY company LIMIT 9", True, None),
    ("SELECT year FROM fact_trips_yellow GROUP BY year LIMIT 9", True, None),
    ("SELECT * FROM dim_time LIMIT 9", True, None),
    ("SELECT * FROM users LIMIT 9", False, "unknown_table"),
    ("SELECT * FROM information_schema.columns LIMIT 9", False, "unknown_table"),
    ("SELECT * FROM dim_zone z JOIN staff s ON 1 = 1 LIMIT 9", False, "unknown_table"),
    ("SELECT * FROM dim_zone", False, "no_limit"),
    ("SELECT * FROM dim_zone LIMIT 1001", False, "limit_too_high"),
    ("SELECT * FROM dim_zone LIMIT 99999999999999999999999999", False, "limit_too_high"),
    ("SELECT * FROM dim_zone LIMIT 0001000", True, None),
    ("SELECT * FROM dim_zone LIMIT 1000", True, None),
    ("SELECT * FROM dim_zone LIMIT 50;", True, None),
    ("SELECT 1 FROM dim_zone LIMIT 1; SELECT 2", False, "multiple_statements"),
    ("", False, "empty"),
    (" \n\t ", False, "empty"),
    (None, False, "empty"),
    # known false refusals and acceptances of a purely textual guard
    ("SELECT EXTRACT(YEAR FROM day) FROM dim_time LIMIT 1", False, "unknown_table"),
    ("SELECT REPLACE(zone, 'a', 'b') FROM dim_zone LIMIT 1", False, "forbidden_word"),
    ("SELECT * FROM dim_zone, users LIMIT 1", True, None),
    ("SELECT limits FROM dim_zone", True, None),
    ("WITH a AS (SELECT 1) SELECT * FROM a LIMIT 1", False, "select_only"),
]


def test_cases(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(CASES)]
    checked = textaudit.validate(spark.createDataFrame(rows, "i int, q string"), "q")
    found = {r.i: (r.valid, r.rule, r.error) for r in checked.collect()}
    for i, (text, accepted, rule) in enumerate(CASES):
        assert found[i][:2] == (accepted, rule), text
        assert (found[i][2] == "") == accepted


def test_error_texts(spark):
    rows = [
        ("SELECT * FROM b_tab JOIN a_tab LIMIT 1",),
        ("SELECT * FROM dim_zone LIMIT 5000",),
        ("SELECT * FROM dim_zone GRANT LIMIT 5000",),
    ]
    checked = textaudit.validate(spark.createDataFrame(rows, "q string"), "q").collect()
    assert [r.error for r in checked] == [
        "Unknown tables referenced: a_tab, b_tab",
        "LIMIT 5000 exceeds maximum allowed (1000)",
        "Forbidden keyword detected: GRANT",
    ]


def test_cleaning_and_capping(spark):
    rows = [
        (0, "```sql\nSELECT 1\n```"),
        (1, "```SQL SELECT 1;;  ```"),
        (2, "  SELECT 1 LIMIT 3 ;  "),
        (3, "SELECT 1;"),
        (4, "SELECT a FROM limits;"),
    ]
    found = textaudit.audit(spark.createDataFrame(rows, "i int, q string"), "q").orderBy("i")
    assert [(r.sanitised, r.limited) for r in found.collect()] == [
        ("SELECT 1", "SELECT 1 LIMIT 100"),
        ("SELECT 1", "SELECT 1 LIMIT 100"),
        ("SELECT 1 LIMIT 3 ", "SELECT 1 LIMIT 3 "),
        ("SELECT 1", "SELECT 1 LIMIT 100"),
        ("SELECT a FROM limits", "SELECT a FROM limits"),
    ]


def rule_of(text: str) -> str | None:
    """The rules spelled out for one text."""
    trimmed = text.strip()
    upper = trimmed.upper()
    if not trimmed:
        return "empty"
    if upper[:6] != "SELECT":
        return "select_only"
    words = set(re.findall(r"\w+", upper))
    if words & set(textaudit.FORBIDDEN_WORDS):
        return "forbidden_word"
    named = re.findall(r"\b(?:FROM|JOIN)\s+([A-Za-z_]\w*)", upper, flags=re.ASCII)
    if any(n.lower() not in textaudit.GUARDED_TABLES for n in named):
        return "unknown_table"
    if "LIMIT" not in upper:
        return "no_limit"
    caps = re.findall(r"\bLIMIT\s+(\d+)", upper)
    if caps and int(caps[0]) > 1000:
        return "limit_too_high"
    return "multiple_statements" if ";" in trimmed.rstrip(";") else None


PIECES = st.sampled_from(
    "SELECT select FROM from JOIN dim_zone fact_trips_yellow users LIMIT limit 5 1000 1001 00012 "
    "; ;; DROP dropped call recall * , ( ) ' WHERE UNION ALL x _call replace".split()
)
TEXTS = st.lists(PIECES, max_size=10).flatmap(
    lambda parts: st.sampled_from([" ", "\n", "  "]).map(lambda gap: gap.join(parts))
)


@settings(max_examples=4, deadline=None)
@given(st.lists(TEXTS, min_size=150, max_size=200), st.booleans())
def test_rules_equal_brute_force(spark, texts, select_first):
    if select_first:
        texts = ["SELECT 1 " + t for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, q string")
    found = {r.i: r.rule for r in textaudit.validate(rows, "q").collect()}
    assert [found[i] for i in range(len(texts))] == [rule_of(t) for t in texts]


def route_of(text: str, routes) -> tuple[str | None, int]:
    best, most = None, 0
    for route in routes:
        hits = len([k for k in route.keywords if k in text.lower()])
        if hits > most:
            best, most = route.name, hits
    return best, most


@settings(max_examples=3, deadline=None)
@given(
    st.lists(
        st.lists(
            st.sampled_from(
                [k for r in routing.TRIP_ROUTES for k in r.keywords] + ["zone", "train", "taxi", "x"]
            ),
            max_size=4,
        ),
        min_size=100,
        max_size=150,
    )
)
def test_routes_equal_brute_force(spark, parts):
    texts = [" ".join(p).title() for p in parts]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, q string")
    found = {r.i: (r.route, r.score) for r in routing.route_questions(rows, "q").collect()}
    assert [found[i] for i in range(len(texts))] == [
        route_of(t, routing.TRIP_ROUTES) for t in texts
    ]


@pytest.mark.parametrize(
    ("question", "route", "by_words"),
    [
        ("a train ride", "weather_impact", None),
        ("nothing to see", None, None),
        ("cash or toll", "payment_patterns", "payment_patterns"),
        ("TIP and cash", "payment_patterns", "payment_patterns"),
        ("", None, None),
    ],
)
def test_substrings_ties_and_misses(spark, question, route, by_words):
    rows = spark.createDataFrame([(question,)], "q string")
    assert routing.route_questions(rows, "q").first().route == route
    assert routing.route_questions(rows, "q", word_boundary=True).first().route == by_words


def test_routing_needs_no_shuffle_and_no_join(spark, plan_text):
    rows = spark.range(10).selectExpr("cast(id as string) AS q")
    plan = plan_text(routing.route_questions(rows, "q"))
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_blanks_around_a_text_include_separators(spark):
    texts = spark.createDataFrame(
        [("\x1cSELECT 1 FROM dim_zone LIMIT 1\x1f",), ("\u00a0\x1d\n",)], "t string"
    )
    rows = textaudit.validate(texts, "t").collect()
    assert [r.rule for r in rows] == [None, "empty"]
