"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tools.check import connect, difference  # noqa: E402
from workload.registry import ORACLES, QUERIES  # noqa: E402

SF_DIR = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def db():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    problem, rows = difference(spark, db, name, SF_DIR)
    assert not problem and rows > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).columns == [
        "year", "borough", "trips", "avg_fare", "avg_tip", "avg_distance", "total_revenue",
        "taxi_type",
    ]
