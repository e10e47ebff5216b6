"""Loan-portfolio aggregates.

Payments and delinquency records are reduced to their loan first, with map-side partial aggregation,
before any join. Everything above loan level is a roll-up of those rows: a payment belongs to one
loan and a loan to one customer, branch and type, so sums, maxima and row counts add up exactly. It
also means that a loan with a huge share of the payments crosses the shuffle as one row per task.
Keys of Silver tables are unique, so counting rows equals counting distinct keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendworks.functions.measures import safe_pct, status_counts, zero_fill

# Output names of the per-status counts.
LOAN_STATUS = {
    "ACTIVE": "active_loan_count",
    "CLOSED": "closed_loan_count",
    "DEFAULTED": "defaulted_loan_count",
}
PAYMENT_STATUS = {
    "PAID": "paid_count",
    "LATE": "late_count",
    "PARTIAL": "partial_count",
    "MISSED": "missed_count",
}

PAYMENT_TOTALS = ("total_emi_records", "total_emi_due", "total_amount_paid", *PAYMENT_STATUS.values())
DELINQUENCY_TOTALS = ("max_days_past_due", "total_overdue_amount", "has_npa_flag", "npa_records")


def _rows() -> Column:
    return F.count(F.lit(1))


def _sums(columns) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _payment_sums() -> list[Column]:
    return [
        _rows().alias("total_emi_records"),
        F.sum("emi_amount").alias("total_emi_due"),
        F.sum("paid_amount").alias("total_amount_paid"),
        *status_counts("payment_status", PAYMENT_STATUS),
    ]


def loan_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy("loan_id").agg(*_payment_sums())


def loan_delinquency(delinquency: DataFrame) -> DataFrame:
    npa = F.when(F.col("npa_flag") == "Y", 1).otherwise(0)
    return delinquency.groupBy("loan_id").agg(
        F.max("days_past_due").alias("max_days_past_due"),
        F.sum("overdue_amount").alias("total_overdue_amount"),
        F.max(npa).alias("has_npa_flag"),
        F.sum(npa).alias("npa_records"),
    )


def loan_book(loans: DataFrame, by_loan: DataFrame, delinquency_by_loan: DataFrame) -> DataFrame:
    """Every accepted loan with its payment and delinquency totals; 0 where it has none."""
    joined = loans.join(by_loan, "loan_id", "left").join(delinquency_by_loan, "loan_id", "left")
    return zero_fill(joined, (*PAYMENT_TOTALS, *DELINQUENCY_TOTALS))


def _payment_measures() -> list[Column]:
    return [
        *_sums(("total_emi_records", "total_emi_due", "total_amount_paid")),
        F.sum("paid_count").alias("paid_emi_count"),
        F.sum("late_count").alias("late_emi_count"),
        F.sum("missed_count").alias("missed_emi_count"),
        F.sum("partial_count").alias("partial_emi_count"),
    ]


def _delinquency_measures() -> list[Column]:
    return [
        F.max("max_days_past_due").alias("max_days_past_due"),
        F.sum("total_overdue_amount").alias("total_overdue_amount"),
        F.max("has_npa_flag").alias("has_npa_flag"),
    ]


def _branch_loan_measures() -> list[Column]:
    return [
        _rows().alias("total_loans"),
        F.count_distinct("customer_id").alias("total_borrowers"),
        F.sum("loan_amount").alias("total_disbursed_amount"),
        F.avg("interest_rate").alias("avg_interest_rate"),
        *status_counts(
            "loan_status",
            {"ACTIVE": "active_loans", "CLOSED": "closed_loans", "DEFAULTED": "defaulted_loans"},
        ),
    ]


def _branch_payment_measures() -> list[Column]:
    return [
        F.sum("total_emi_due").alias("total_emi_due"),
        F.sum("total_amount_paid").alias("total_collected_amount"),
        F.sum("missed_count").alias("missed_emi_count"),
        F.sum("late_count").alias("late_emi_count"),
    ]


def _branch_delinquency_measures() -> list[Column]:
    return [
        F.sum("total_overdue_amount").alias("total_overdue_amount"),
        F.max("max_days_past_due").alias("max_days_past_due"),
        F.sum("npa_records").alias("npa_records"),
    ]


def customer_book(book: DataFrame) -> DataFrame:
    """All customer-level measures in one aggregation over the loan book; customers with loans only."""
    return book.groupBy("customer_id").agg(
        _rows().alias("total_loans"),
        F.sum("loan_amount").alias("total_loan_amount"),
        F.avg("interest_rate").alias("avg_interest_rate"),
        *status_counts("loan_status", LOAN_STATUS),
        *_payment_measures(),
        *_delinquency_measures(),
    )


def branch_book(book: DataFrame) -> DataFrame:
    """All branch-level measures in one aggregation over the loan book."""
    return book.groupBy("branch_id").agg(
        *_branch_loan_measures(), *_branch_payment_measures(), *_branch_delinquency_measures()
    )


def monthly_collection(payments: DataFrame) -> DataFrame:
    """One row per EMI due month and loan type; ``payments`` carry the type of their loan.

    Spark counts the distinct loans by pre-aggregating per month, type and loan, so a month with
    most of the payments is still spread by loan.
    """
    totals = payments.groupBy(due_month(), "loan_type").agg(
        *_payment_sums(), F.count_distinct("loan_id").alias("total_loans")
    )
    return _monthly_rates(totals)


def due_month() -> Column:
    return F.date_format("emi_due_date", "yyyy-MM").alias("emi_due_month")


def monthly_from_loans(month_loans: DataFrame) -> DataFrame:
    """The same from payment totals per month, type and loan, so that each loan is a row to count."""
    sums = _sums(PAYMENT_TOTALS)
    return _monthly_rates(month_loans.groupBy("emi_due_month", "loan_type").agg(*sums, _rows().alias("total_loans")))


def _monthly_rates(totals: DataFrame) -> DataFrame:
    return totals.select(
        "emi_due_month",
        "loan_type",
        "total_emi_records",
        "total_loans",
        "total_emi_due",
        "total_amount_paid",
        *PAYMENT_STATUS.values(),
        safe_pct("total_amount_paid", "total_emi_due").alias("collection_rate"),
        safe_pct("missed_count", "total_emi_records").alias("missed_rate"),
    )
