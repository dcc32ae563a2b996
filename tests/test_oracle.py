"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from vuelometria.checks import ORACLES, QUERIES
from vuelometria.checks.compare import connect, differences


@pytest.fixture(scope="module")
def duck(folder):
    con = connect(folder)
    yield con
    con.close()


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, folder, duck, key):
    assert differences(QUERIES[key](spark, folder), duck, ORACLES[key]) == []


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
