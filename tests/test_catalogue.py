from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from lendworks.catalogue import oracle
from lendworks.catalogue.queries import QUERIES
from tests.oracle_check import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duckdb_tables():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, duckdb_tables, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert differences(df, duckdb_tables, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "branch_id" and df.count() > 0
