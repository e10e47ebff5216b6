from __future__ import annotations

import pytest

from lendworks.operators import expect
from lendworks.operators.expect import Expectation, run_suite
from lendworks.plans.checks import gold_suite
from tests.helpers import rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", "X", -1.0), ("a", "Y", 50.0), ("b", "Z", 101.0), (None, None, None), (None, "Z", 100.0)],
        "k string, v string, r double",
    )


def test_single_expectations(spark, table):
    assert rows(expect.duplicate_keys(table, "k")) == [("a", 2)]  # NULL keys are not duplicates
    parent = spark.createDataFrame([("a",)], "id string")
    assert rows(expect.unmatched_keys(table, "k", parent, "id")) == [("b", 1)]


@pytest.mark.parametrize("hot", [(), ("a",), ("a", None, "absent")])
def test_dealt_keys_are_the_same_duplicates_and_not_counted_before_the_shuffle(spark, hot):
    table = spark.createDataFrame([(k,) for k in ["a"] * 5 + ["b", "b", "c", "", "", None, None]], "k string")
    found = expect.duplicate_keys(table, "k", hot, tasks=3)
    assert rows(found) == rows(expect.duplicate_keys(table, "k")) == [("", 2), ("a", 5), ("b", 2)]
    assert "RepartitionByExpression" in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "test,column,values,failing",
    [("not_null", "k", (), 2), ("accepted_values", "v", ("X", "Y"), 2), ("non_negative", "r", (), 1), ("rate_range", "r", (0, 100), 2)],
)
def test_rows_that_fail_are_those_the_suite_counts(table, test, column, values, failing):
    e = Expectation("s", "t", test, column, values)
    assert expect.failing_rows(table, e).count() == failing
    assert run_suite([e], {"t": table}).first()["failures"] == failing


def test_suite_counts_failures_of_all_kinds(spark, table):
    parent = spark.createDataFrame([("a",)], "k string")
    suite = [
        Expectation("s", "t", "not_null", "k"),
        Expectation("s", "t", "unique", "k"),
        Expectation("s", "view", "unique", "k"),
        Expectation("s", "t", "accepted_values", "v", ("X", "Y")),
        Expectation("s", "t", "relationships", "k", ("p", "k")),
        Expectation("s", "t", "non_negative", "r"),
        Expectation("s", "t", "rate_range", "r", (0, 100)),
        Expectation("s", "t", "row_count", "", (5,)),
        Expectation("s", "view", "row_count", "", (1,)),
    ]
    got = run_suite(suite, {"t": table, "p": parent}, {"view": "t"})
    assert got.columns == ["suite", "model", "test", "column_name", "failures"]
    failures = {(r.model, r.test): r.failures for r in got.collect()}
    assert failures == {
        ("t", "not_null"): 2,
        ("t", "unique"): 1,
        ("view", "unique"): 1,
        ("t", "accepted_values"): 2,
        ("t", "relationships"): 1,
        ("t", "non_negative"): 1,
        ("t", "rate_range"): 2,
        ("t", "row_count"): 0,
        ("view", "row_count"): 1,
    }


def test_gold_suite_has_35_tests():
    suite = gold_suite()
    per_suite = {s: sum(e.suite == s for e in suite) for s in ("source", "staging", "mart", "singular")}
    assert per_suite == {"source": 9, "staging": 13, "mart": 10, "singular": 3}
    assert len(set(suite)) == 35
