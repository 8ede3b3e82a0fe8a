"""Every registered query against its SQL oracle."""

import os

import pytest

import __spark_entry__ as entry
from strataflow import plans
import compare

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = plans.QUERIES, plans.ORACLES


@pytest.fixture(scope="module")
def con():
    return compare.oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_oracle(spark, con, name):
    columns, got = compare.spark_rows(QUERIES[name](spark, SF))
    wanted_columns, want = compare.oracle_rows(con, ORACLES[name])
    assert columns == wanted_columns
    assert got == want, compare.difference(got, want)
