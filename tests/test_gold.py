from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lendworks.functions import risk
from lendworks.functions.measures import safe_pct, status_counts, zero_fill
from lendworks.operators import rollups
from lendworks.plans import gold as marts
from lendworks.plans.gold import GoldLayer
from lendworks.plans.silver import SilverLayer
from lendworks.sources.registry import SOURCES
from tests.helpers import Memory, bronze, record, rows


def test_safe_pct_rounds_half_up_and_never_divides_by_zero(spark):
    df = spark.createDataFrame(
        [(1, 3), (2, 3), (5, 0), (5, None), (None, 4), (201, 20000), (150, 100)], "a long, b long"
    )
    got = [r[0] for r in df.select(safe_pct("a", "b")).collect()]
    assert got == [33.33, 66.67, 0.0, 0.0, None, 1.01, 150.0]


def test_status_counts_and_zero_fill(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "s string")
    counts = status_counts("s", {"A": "a", "B": "b", "C": "c"})
    assert tuple(df.agg(*counts).first()) == (2, 1, 0)
    assert tuple(df.filter("false").agg(*counts).first()) == (None, None, None)
    filled = zero_fill(spark.createDataFrame([(None, None, None)], "n int, d double, t string"), "nd")
    assert tuple(filled.first()) == (0, 0.0, None)


def banded(spark, schema, values, column):
    df = spark.createDataFrame(values, schema)
    return [r[0] for r in df.select(column).collect()]


def test_loan_risk_score_boundaries(spark):
    schema = "has_npa_flag int, max_days_past_due int, missed_count int, late_count int, partial_count int"
    cases = {
        (1, 0, 0, 0, 0): 100,
        (0, 90, 0, 0, 0): 100,
        (0, 89, 0, 0, 0): 80,
        (0, 60, 0, 0, 0): 80,
        (0, 0, 2, 0, 0): 80,
        (0, 59, 0, 0, 0): 60,
        (0, 30, 0, 0, 0): 60,
        (0, 0, 1, 0, 0): 60,
        (0, 0, 0, 2, 0): 60,
        (0, 29, 0, 1, 0): 40,
        (0, 0, 0, 0, 1): 40,
        (0, 29, 0, 0, 0): 20,
    }
    assert banded(spark, schema, list(cases), risk.loan_risk_score()) == list(cases.values())


@pytest.mark.parametrize(
    "schema, band, cases",
    [
        (
            "s int",
            lambda: risk.risk_band("s"),
            {(100,): "CRITICAL", (90,): "CRITICAL", (89,): "HIGH", (70,): "HIGH", (69,): "MEDIUM",
             (50,): "MEDIUM", (49,): "LOW"},
        ),
        (
            "has_npa_flag int, max_days_past_due int, missed_emi_count int",
            risk.customer_risk_category,
            {(1, 0, 0): "HIGH", (0, 90, 0): "HIGH", (0, 89, 0): "MEDIUM", (0, 30, 0): "MEDIUM",
             (0, 0, 1): "MEDIUM", (0, 29, 0): "LOW"},
        ),
        (
            "default_rate double, collection_rate double",
            risk.branch_health,
            {(10.0, 100.0): "HIGH_RISK_BRANCH", (0.0, 74.99): "HIGH_RISK_BRANCH",
             (0.0, 0.0): "HIGH_RISK_BRANCH", (9.99, 90.0): "WATCHLIST_BRANCH",
             (5.0, 95.0): "WATCHLIST_BRANCH", (0.0, 75.0): "WATCHLIST_BRANCH",
             (0.0, 89.99): "WATCHLIST_BRANCH", (4.99, 90.0): "HEALTHY_BRANCH"},
        ),
        (
            "collection_rate double",
            risk.collection_band,
            {(95.0,): "EXCELLENT", (94.99,): "GOOD", (85.0,): "GOOD", (84.99,): "NEEDS_ATTENTION",
             (70.0,): "NEEDS_ATTENTION", (69.99,): "POOR"},
        ),
        (
            "high_risk_loan_rate double, default_rate double",
            risk.portfolio_health,
            {(15.0, 0.0): "HIGH_PORTFOLIO_RISK", (0.0, 10.0): "HIGH_PORTFOLIO_RISK",
             (8.0, 0.0): "MEDIUM_PORTFOLIO_RISK", (0.0, 5.0): "MEDIUM_PORTFOLIO_RISK",
             (7.99, 4.99): "LOW_PORTFOLIO_RISK"},
        ),
    ],
)
def test_bands(spark, schema, band, cases):
    assert banded(spark, schema, list(cases), band()) == list(cases.values())


@pytest.fixture(scope="module")
def silver(spark):
    loan, pay, dlq = "loan_accounts", "emi_payments", "delinquency"
    data = {
        "branch_master": [record("branch_master"), record("branch_master", branch_id="BR2")],
        "customers": [record("customers", customer_id=f"C{i}") for i in (1, 2, 3)],
        loan: [
            record(loan),
            record(loan, loan_id="L2", loan_amount=3000, interest_rate=9.5, loan_status="DEFAULTED"),
            record(loan, loan_id="L3", customer_id="C2", loan_type="auto_loan"),
        ],
        pay: [
            record(pay),
            record(pay, payment_id="P2", paid_amount=50, payment_status="PARTIAL"),
            record(pay, payment_id="P3", loan_id="L2", paid_amount=0, payment_status="MISSED"),
            record(pay, payment_id="P4", loan_id="L2", emi_due_date="2024-05-05", payment_status="LATE"),
            record(pay, payment_id="P5", loan_id="L3", emi_due_date="not a date"),
        ],
        dlq: [
            record(dlq, loan_id="L2", days_past_due=95, overdue_amount=40, npa_flag="Y"),
            record(dlq, delinquency_id="D2", loan_id="L2", days_past_due=20, overdue_amount=2),
        ],
    }
    frames = {s: bronze(spark, s, *data.get(s, [record(s)])) for s in SOURCES}
    return SilverLayer(frames, Memory().table)


@pytest.fixture(scope="module")
def gold(silver):
    return GoldLayer(silver, Memory().table)


def one(df, **where):
    for column, value in where.items():
        df = df.filter(F.col(column) == value)
    (row,) = df.collect()
    return row.asDict()


def test_customer_mart(gold):
    mart = gold.customer_loan_summary()
    assert mart.columns == marts.CUSTOMER_COLUMNS and len(mart.columns) == 26
    c1 = one(mart, customer_id="C1")
    assert (c1["total_loans"], c1["total_loan_amount"], c1["avg_interest_rate"]) == (2, 4000, 9.0)
    assert (c1["active_loan_count"], c1["closed_loan_count"], c1["defaulted_loan_count"]) == (1, 0, 1)
    assert (c1["total_emi_records"], c1["total_emi_due"], c1["total_amount_paid"]) == (4, 400, 250)
    assert (c1["collection_rate"], c1["missed_emi_count"], c1["late_emi_count"]) == (62.5, 1, 1)
    assert (c1["max_days_past_due"], c1["total_overdue_amount"], c1["has_npa_flag"]) == (95, 42, 1)
    assert c1["risk_category"] == "HIGH"
    idle = one(mart, customer_id="C3")
    assert (idle["total_loans"], idle["avg_interest_rate"], idle["collection_rate"]) == (0, 0.0, 0.0)
    assert idle["risk_category"] == "LOW"


def test_branch_mart(gold):
    mart = gold.branch_performance_summary()
    assert mart.columns == marts.BRANCH_COLUMNS and len(mart.columns) == 22
    b1 = one(mart, branch_id="BR1")
    assert (b1["total_loans"], b1["total_borrowers"], b1["default_rate"]) == (3, 2, 33.33)
    assert (b1["npa_records"], b1["collection_rate"]) == (1, 70.0)
    assert one(mart, branch_id="BR2")["total_loans"] == 0


def test_loan_mart_and_kpis(gold):
    mart = gold.loan_default_risk_summary()
    assert mart.columns == marts.LOAN_COLUMNS and len(mart.columns) == 29
    assert one(mart, loan_id="L2")["risk_category"] == "CRITICAL"
    assert one(mart, loan_id="L1")["risk_score"] == 40
    assert one(mart, loan_id="L3")["region"] == "West"
    kpis = gold.portfolio_kpis().first()
    assert (kpis.total_loans, kpis.total_customers, kpis.total_loan_portfolio) == (3, 2, 5000)
    assert (kpis.high_risk_loans, kpis.high_risk_loan_rate, kpis.avg_risk_score) == (1, 33.33, 53.33)


def test_monthly_mart_keeps_payments_without_a_due_month(gold, silver):
    mart = gold.monthly_collection_summary().select(
        "emi_due_month", "loan_type", "total_emi_records", "total_loans", "collection_rate", "missed_rate"
    )
    assert rows(mart) == [
        ("2024-04", "HOME_LOAN", 3, 2, 50.0, 33.33),
        ("2024-05", "HOME_LOAN", 1, 1, 100.0, 0.0),
        (None, "AUTO_LOAN", 1, 1, 100.0, 0.0),
    ]


def test_empty_portfolio_still_has_one_kpi_row(gold):
    kpis = marts.portfolio_kpis(gold.loan_risk().filter("false")).drop("kpi_date").first()
    assert (kpis.total_loans, kpis.total_customers) == (0, 0)
    assert (kpis.total_loan_portfolio, kpis.active_loans, kpis.avg_risk_score) == (None, None, None)
    assert (kpis.collection_rate, kpis.default_rate, kpis.high_risk_loan_rate) == (0.0, 0.0, 0.0)


def test_planned_tables(gold):
    planned = gold.planned_tables()
    branch = one(planned["branch_risk_summary"], branch_id="BR1")
    assert (branch["npa_loans"], branch["npa_rate"], branch["overdue_rate"]) == (1, 33.33, 0.84)
    assert branch["branch_health_status"] == "HIGH_RISK_BRANCH"
    npa = one(planned["npa_summary"], loan_type="HOME_LOAN")
    assert (npa["npa_loans"], npa["npa_amount"], npa["npa_rate"]) == (1, 3000, 50.0)
    score = one(planned["customer_risk_score"], customer_id="C1")
    assert (score["max_risk_score"], score["exposure_weighted_score"]) == (100, 85.0)
    assert score["risk_category"] == "CRITICAL"


def test_hot_keys_do_not_change_the_loan_mart(silver, gold):
    book = rollups.loan_book(
        silver.table("loan_accounts").select(*SOURCES["loan_accounts"].columns),
        gold.loan_payments(),
        gold.loan_delinquency(),
    )
    spread = marts.loan_default_risk(
        book,
        silver.table("customers"),
        silver.table("branch_master"),
        {"customer_id": ["C1"], "branch_id": ["BR1"]},
    )
    assert rows(spread) == rows(gold.loan_risk())


def test_listed_keys_do_not_repeat_the_joins_by_loan(silver, gold, monkeypatch):
    listed = {"customer_id": ["C1"], "branch_id": ["BR1"]}
    monkeypatch.setattr(silver, "hot", lambda source: listed)
    built = GoldLayer(silver, lambda name, build: build()).loan_risk()
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sum(paid_amount") == 1 and plan.count("sum(overdue_amount") == 1
    assert rows(built) == rows(gold.loan_risk())


def test_the_loan_mart_builds_the_sources_it_reads(silver, gold):
    memory, asked = Memory(), []
    fresh = SilverLayer(silver._bronze, memory.table)
    fresh.build, build = lambda *sources: asked.append(sources) or build(*sources), fresh.build
    assert rows(GoldLayer(fresh, Memory().table).loan_risk()) == rows(gold.loan_risk())
    assert asked == [marts.LOAN_SOURCES]
    assert set(memory.saved) == {f"validated_{s}" for s in marts.LOAN_SOURCES}
