"""Ranked reports, staging views and reporting marts over the Gold layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lendworks.functions import risk


def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return (
        customers.select(
            "customer_id",
            "customer_name",
            "total_loans",
            "total_loan_amount",
            "collection_rate",
            "max_days_past_due",
            "total_overdue_amount",
            "risk_category",
        )
        .orderBy(F.desc("total_loan_amount"), "customer_id")
        .limit(n)
    )


def branch_ranking(branches: DataFrame) -> DataFrame:
    return branches.select(
        "branch_id",
        "branch_name",
        "city",
        "region",
        "total_loans",
        "total_disbursed_amount",
        "collection_rate",
        "default_rate",
        "total_overdue_amount",
    ).orderBy(F.desc("total_disbursed_amount"), "branch_id")


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy("emi_due_month", "loan_type")


def riskiest_loans(loan_risk: DataFrame, n: int = 20) -> DataFrame:
    return (
        loan_risk.select(
            "loan_id",
            "customer_id",
            "customer_name",
            "loan_type",
            "loan_amount",
            "collection_rate",
            "missed_count",
            "max_days_past_due",
            "total_overdue_amount",
            "risk_score",
            "risk_category",
        )
        .orderBy(F.desc("risk_score"), F.desc("total_overdue_amount"), "loan_id")
        .limit(n)
    )


# Staging view -> Gold table it passes through.
STAGING_VIEWS = {
    "stg_customer_loan_summary": "customer_loan_summary",
    "stg_branch_performance_summary": "branch_performance_summary",
    "stg_monthly_collection_summary": "monthly_collection_summary",
    "stg_loan_default_risk_summary": "loan_default_risk_summary",
    "stg_portfolio_kpis": "portfolio_kpis",
}


# Columns of the reporting marts in their published order; a rule's own column comes last.
HIGH_RISK_LOANS = """loan_id customer_id customer_name branch_id branch_name region loan_type loan_amount collection_rate
    missed_count max_days_past_due total_overdue_amount risk_score risk_category""".split()
BRANCH_RISK_DASHBOARD = """branch_id branch_name city state region total_loans total_borrowers total_disbursed_amount
    collection_rate default_rate total_overdue_amount npa_records""".split()
COLLECTION_TREND = """emi_due_month loan_type total_emi_records total_loans total_emi_due total_amount_paid collection_rate
    missed_rate paid_count late_count partial_count missed_count""".split()
PORTFOLIO_EXECUTIVE_SUMMARY = """kpi_date total_loans total_customers total_loan_portfolio total_emi_due
    total_amount_collected total_overdue_amount active_loans closed_loans defaulted_loans high_risk_loans avg_risk_score
    collection_rate default_rate high_risk_loan_rate""".split()


def high_risk_loans(loan_risk: DataFrame) -> DataFrame:
    risky = loan_risk.filter(F.col("risk_category").isin("CRITICAL", "HIGH"))
    return risky.select(*HIGH_RISK_LOANS, F.lit(True).alias("requires_collection_attention"))


def branch_risk_dashboard(branches: DataFrame) -> DataFrame:
    """A branch without dues has collection rate 0 and so counts as high risk."""
    return branches.select(*BRANCH_RISK_DASHBOARD, risk.branch_health().alias("branch_health_status"))


def collection_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select(*COLLECTION_TREND, risk.collection_band().alias("collection_performance_band"))


def portfolio_executive_summary(kpis: DataFrame) -> DataFrame:
    return kpis.select(*PORTFOLIO_EXECUTIVE_SUMMARY, risk.portfolio_health().alias("portfolio_health_status"))


def reporting_marts(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "mart_high_risk_loans": high_risk_loans(gold["loan_default_risk_summary"]),
        "mart_branch_risk_dashboard": branch_risk_dashboard(gold["branch_performance_summary"]),
        "mart_collection_trend": collection_trend(gold["monthly_collection_summary"]),
        "mart_portfolio_executive_summary": portfolio_executive_summary(gold["portfolio_kpis"]),
    }
