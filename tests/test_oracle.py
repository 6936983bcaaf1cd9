"""Every registered query against its DuckDB oracle on the smallest test data,
plus the driver's smoke entry."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from acctflow.plans.queries import QUERIES
from tests.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "Alert_Key" in df.columns
