"""Registered queries against their SQL, at the smallest scale factor."""

import os

import pytest
from compare import connect, oracle_rows, spark_rows

from agorascope.plans.oracles import ORACLES
from agorascope.plans.queries import REGISTRY, flagship

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    got = spark_rows(REGISTRY[name](spark, SF_DIR))
    assert got == oracle_rows(con, ORACLES[name])


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(REGISTRY)


def test_flagship(spark):
    rows = flagship(spark, SF_DIR).collect()
    assert 0 < len(rows) <= 10 and rows[0]["volume"] >= rows[-1]["volume"]
