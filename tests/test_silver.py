from __future__ import annotations

from lendworks.operators.validate import orphans, rejects_by_rule
from lendworks.plans.silver import SilverLayer
from lendworks.sources.registry import SOURCES
from tests.helpers import Memory, bronze, keys, record, rows


def feeds(spark, **records):
    return {s: bronze(spark, s, *records.get(s, [record(s)])) for s in SOURCES}


def test_rejection_cascades_over_three_levels(spark):
    layer = SilverLayer(
        feeds(spark, customers=[record("customers", annual_income=0)]), Memory().table
    )
    assert rows(layer.all_rejects().select("source_table", "rule_code")) == [
        ("bronze_customers", "CUST_005"),
        ("bronze_delinquency", "DLQ_002"),
        ("bronze_emi_payments", "EMI_003"),
        ("bronze_loan_accounts", "LOAN_003"),
        ("bronze_loan_applications", "APP_003"),
    ]
    assert layer.table("branch_master").count() == 1
    assert layer.table("emi_payments").count() == 0


def test_documented_dirt(spark):
    """One of each data quality scenario the feeds are known to contain."""
    c, n, p, d = "customers", "loan_accounts", "emi_payments", "delinquency"
    layer = SilverLayer(
        feeds(
            spark,
            customers=[
                record(c),
                record(c),
                record(c, customer_id="C2", customer_name=None, credit_score=None),
            ],
            loan_accounts=[
                record(n),
                record(n, loan_id="L2", loan_amount=-7),
                record(n, loan_id="L3", customer_id="C99"),
            ],
            emi_payments=[
                record(p),
                record(p),
                record(p, payment_id="P2", loan_id="L99"),
            ],
            delinquency=[
                record(d),
                record(d, delinquency_id="D2", loan_id="L2"),
                record(d, delinquency_id="D3", loan_id="L99"),
                record(d, delinquency_id="D4", days_past_due=-10, overdue_amount=-1),
            ],
        ),
        Memory().table,
    )
    assert rows(rejects_by_rule(layer.all_rejects()).select("rule_code", "rejected_count")) == [
        ("CUST_002", 1),
        ("CUST_003", 1),
        ("CUST_004", 1),
        ("DLQ_002", 2),
        ("DLQ_003", 1),
        ("DLQ_004", 1),
        ("EMI_002", 1),
        ("EMI_003", 1),
        ("LOAN_003", 1),
        ("LOAN_005", 1),
    ]
    balance = {r["source"]: r for r in layer.reconciliation().collect()}
    assert all(r["balanced"] for r in balance.values())
    assert (balance["customers"]["bronze_rows"], balance["customers"]["rejected_rows"]) == (3, 2)
    assert balance["delinquency"]["reject_records"] == 4


def test_no_rejects_gives_an_empty_envelope(spark):
    rejects = SilverLayer(feeds(spark), Memory().table).all_rejects()
    assert rejects.count() == 0
    assert [t for _, t in rejects.dtypes] == ["string"] * 4 + ["timestamp", "string"]


def test_delinquency_keeps_repeated_records(spark):
    twice = [record("delinquency"), record("delinquency")]
    layer = SilverLayer(feeds(spark, delinquency=twice), Memory().table)
    assert layer.table("delinquency").count() == 2


def test_orphans_include_null_references(spark):
    df = spark.createDataFrame([("a", "L1"), ("b", "L2"), ("c", None)], "id string, loan_id string")
    assert rows(orphans(df, "loan_id", keys(spark, "loan_id", "L1"), ["L2"])) == [
        ("b", "L2"),
        ("c", None),
    ]


def test_survivor_does_not_depend_on_input_order(spark):
    from pyspark.sql import functions as F

    from lendworks.operators.validate import dedupe_latest

    spec = SOURCES["emi_payments"]
    versions = [record(spec.name, paid_amount=a, emi_paid_date=d) for a in (1, 9, 5) for d in (None, "2024-04-07")]
    df = bronze(spark, spec.name, *versions)
    first = dedupe_latest(df, spec).select(*spec.columns).collect()
    second = dedupe_latest(df.orderBy(F.rand(3)), spec, ["P1"]).select(*spec.columns).collect()
    assert first == second and first[0]["paid_amount"] == 9 and first[0]["emi_paid_date"] is None
