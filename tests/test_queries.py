"""Every query against its SQL twin on the small tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference, type_difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [q for q in QUERIES if q in ORACLE])
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert type_difference(df.dtypes, con, ORACLE[name]) is None
    assert difference(df.toPandas(), con.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ORACLE])
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["pickup_hour", "MAE"]
