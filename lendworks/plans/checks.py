"""The expectation suite of the Gold layer and the reporting models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lendworks.operators.expect import Expectation, run_suite
from lendworks.plans.reporting import STAGING_VIEWS

_LOAN_RISK = ("LOW", "MEDIUM", "HIGH", "CRITICAL")


def _key(suite: str, model: str, column: str) -> list[Expectation]:
    return [Expectation(suite, model, t, column) for t in ("not_null", "unique")]


def _present(suite: str, model: str, *columns: str) -> list[Expectation]:
    return [Expectation(suite, model, "not_null", c) for c in columns]


def _domain(suite: str, model: str, column: str, *values: str) -> list[Expectation]:
    return [Expectation(suite, model, "accepted_values", column, values)]


def gold_suite() -> list[Expectation]:
    """Fixed list: 9 source, 13 staging, 10 mart and 3 singular tests."""
    return [
        *_key("source", "gold_customer_loan_summary", "customer_id"),
        *_key("source", "gold_branch_performance_summary", "branch_id"),
        *_present("source", "gold_monthly_collection_summary", "emi_due_month", "loan_type"),
        *_key("source", "gold_loan_default_risk_summary", "loan_id"),
        *_present("source", "gold_loan_default_risk_summary", "customer_id"),
        *_key("staging", "stg_customer_loan_summary", "customer_id"),
        *_domain("staging", "stg_customer_loan_summary", "risk_category", "LOW", "MEDIUM", "HIGH"),
        *_key("staging", "stg_branch_performance_summary", "branch_id"),
        *_domain("staging", "stg_branch_performance_summary", "is_active", "Y", "N"),
        *_key("staging", "stg_loan_default_risk_summary", "loan_id"),
        *_present("staging", "stg_loan_default_risk_summary", "customer_id"),
        Expectation(
            "staging",
            "stg_loan_default_risk_summary",
            "relationships",
            "customer_id",
            ("stg_customer_loan_summary", "customer_id"),
        ),
        *_domain("staging", "stg_loan_default_risk_summary", "risk_category", *_LOAN_RISK),
        *_present("staging", "stg_monthly_collection_summary", "emi_due_month", "loan_type"),
        *_key("mart", "mart_high_risk_loans", "loan_id"),
        *_domain("mart", "mart_high_risk_loans", "risk_category", "HIGH", "CRITICAL"),
        *_key("mart", "mart_branch_risk_dashboard", "branch_id"),
        *_domain(
            "mart",
            "mart_branch_risk_dashboard",
            "branch_health_status",
            "HEALTHY_BRANCH",
            "WATCHLIST_BRANCH",
            "HIGH_RISK_BRANCH",
        ),
        *_present("mart", "mart_collection_trend", "emi_due_month"),
        *_domain(
            "mart",
            "mart_collection_trend",
            "collection_performance_band",
            "EXCELLENT",
            "GOOD",
            "NEEDS_ATTENTION",
            "POOR",
        ),
        *_present("mart", "mart_portfolio_executive_summary", "kpi_date"),
        *_domain(
            "mart",
            "mart_portfolio_executive_summary",
            "portfolio_health_status",
            "LOW_PORTFOLIO_RISK",
            "MEDIUM_PORTFOLIO_RISK",
            "HIGH_PORTFOLIO_RISK",
        ),
        Expectation("singular", "stg_loan_default_risk_summary", "non_negative", "loan_amount"),
        Expectation(
            "singular", "stg_loan_default_risk_summary", "rate_range", "collection_rate", (0, 100)
        ),
        Expectation("singular", "stg_portfolio_kpis", "row_count", "", (1,)),
    ]


def check_gold(gold: Mapping[str, DataFrame], marts: Mapping[str, DataFrame]) -> DataFrame:
    """Run the suite on Gold tables keyed by bare name and marts keyed by full name."""
    models = {f"gold_{n}": df for n, df in gold.items()} | dict(marts)
    same = {view: f"gold_{table}" for view, table in STAGING_VIEWS.items()}
    return run_suite(gold_suite(), models, same)
