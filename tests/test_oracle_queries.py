"""Every query on the reference's operators against its SQL on the smallest test tables, whole tables each."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference
from workload.registry import ORACLES, QUERIES

SF_DIR = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["facility", "disease"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
