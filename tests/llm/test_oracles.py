"""Every training-data query that SQL can express, against its SQL; the others are tested against brute force."""

from __future__ import annotations

import pytest

from lendworks.llm import oracle
from lendworks.llm.queries import QUERIES
from tests.oracle_check import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), oracle.oracle_sql()[name]) is None


def test_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
