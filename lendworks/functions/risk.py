"""Risk classification. Bands and thresholds are fixed values of the business definition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def first_match(cases: list[tuple[Column, object]], default: object) -> Column:
    """The value of the first case whose condition is TRUE."""
    chain = reduce(lambda acc, case: acc.when(case[0], case[1]), cases, F)
    return chain.otherwise(default)


def customer_risk_category() -> Column:
    npa, dpd, missed = F.col("has_npa_flag"), F.col("max_days_past_due"), F.col("missed_emi_count")
    return first_match(
        [((npa == 1) | (dpd >= 90), "HIGH"), ((missed > 0) | (dpd >= 30), "MEDIUM")], "LOW"
    )


def loan_risk_score() -> Column:
    npa, dpd = F.col("has_npa_flag"), F.col("max_days_past_due")
    missed, late, partial = F.col("missed_count"), F.col("late_count"), F.col("partial_count")
    return first_match(
        [
            ((npa == 1) | (dpd >= 90), 100),
            ((missed >= 2) | (dpd >= 60), 80),
            ((missed == 1) | (late >= 2) | (dpd >= 30), 60),
            ((late == 1) | (partial >= 1), 40),
        ],
        20,
    )


LOAN_BANDS = ((90, "CRITICAL"), (70, "HIGH"), (50, "MEDIUM"))


def risk_band(score: str) -> Column:
    return first_match([(F.col(score) >= low, name) for low, name in LOAN_BANDS], "LOW")


def branch_health() -> Column:
    default, collected = F.col("default_rate"), F.col("collection_rate")
    return first_match(
        [
            ((default >= 10) | (collected < 75), "HIGH_RISK_BRANCH"),
            ((default >= 5) | (collected < 90), "WATCHLIST_BRANCH"),
        ],
        "HEALTHY_BRANCH",
    )


COLLECTION_BANDS = ((95, "EXCELLENT"), (85, "GOOD"), (70, "NEEDS_ATTENTION"))


def collection_band() -> Column:
    rate = F.col("collection_rate")
    return first_match([(rate >= low, name) for low, name in COLLECTION_BANDS], "POOR")


def portfolio_health() -> Column:
    risky, default = F.col("high_risk_loan_rate"), F.col("default_rate")
    return first_match(
        [
            ((risky >= 15) | (default >= 10), "HIGH_PORTFOLIO_RISK"),
            ((risky >= 8) | (default >= 5), "MEDIUM_PORTFOLIO_RISK"),
        ],
        "LOW_PORTFOLIO_RISK",
    )
