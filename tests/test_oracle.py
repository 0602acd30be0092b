"""Every registered query against its SQL, on whole tables."""

import os

import pytest

from compare import connect, difference
from fleetgauge.plans.catalog import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
