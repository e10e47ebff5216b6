"""Gold marts assembled from Silver tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lendworks.functions import risk
from lendworks.functions.measures import safe_pct, status_counts, zero_fill
from lendworks.operators import rollups
from lendworks.operators.skew import lookup_join
from lendworks.plans.silver import SilverLayer
from lendworks.sources.registry import SOURCES

Hot = Mapping[str, Iterable]

# Sources that the loan-level result reads.
LOAN_SOURCES = ("branch_master", "customers", "loan_accounts", "emi_payments", "delinquency")

# Column order of the published marts.
CUSTOMER_COLUMNS = """customer_id customer_name gender city state employment_type annual_income
    credit_score total_loans total_loan_amount avg_interest_rate active_loan_count
    closed_loan_count defaulted_loan_count total_emi_records total_emi_due total_amount_paid
    collection_rate paid_emi_count late_emi_count missed_emi_count partial_emi_count
    max_days_past_due total_overdue_amount has_npa_flag risk_category""".split()
BRANCH_COLUMNS = """branch_id branch_name city state region is_active total_loans total_borrowers
    total_disbursed_amount avg_interest_rate active_loans closed_loans defaulted_loans default_rate
    total_emi_due total_collected_amount collection_rate missed_emi_count late_emi_count
    total_overdue_amount max_days_past_due npa_records""".split()
LOAN_COLUMNS = """loan_id application_id customer_id customer_name credit_score annual_income
    branch_id branch_name city state region loan_type loan_amount interest_rate loan_start_date
    loan_status total_emi_records total_emi_due total_amount_paid collection_rate paid_count
    late_count partial_count missed_count max_days_past_due total_overdue_amount has_npa_flag
    risk_score risk_category""".split()


def stamped(df: DataFrame, as_at: Column | None = None) -> DataFrame:
    return df.select(
        "*",
        (F.current_timestamp() if as_at is None else as_at).alias("gold_processed_timestamp"),
        F.lit("GOLD").alias("pipeline_layer"),
    )


def customer_loan_summary(customers: DataFrame, book: DataFrame) -> DataFrame:
    """One row per accepted customer, with or without loans."""
    measures = rollups.customer_book(book)
    joined = customers.join(measures, "customer_id", "left")
    filled = zero_fill(joined, [c for c in measures.columns if c != "customer_id"])
    return filled.withColumns(
        {
            "collection_rate": safe_pct("total_amount_paid", "total_emi_due"),
            "risk_category": risk.customer_risk_category(),
        }
    ).select(*CUSTOMER_COLUMNS)


def branch_performance_summary(branches: DataFrame, book: DataFrame) -> DataFrame:
    """One row per accepted branch, with or without loans."""
    measures = rollups.branch_book(book)
    joined = branches.join(measures, "branch_id", "left")
    filled = zero_fill(joined, [c for c in measures.columns if c != "branch_id"])
    return filled.withColumns(
        {
            "collection_rate": safe_pct("total_collected_amount", "total_emi_due"),
            "default_rate": safe_pct("defaulted_loans", "total_loans"),
        }
    ).select(*BRANCH_COLUMNS)


def located(
    loans: DataFrame, customers: DataFrame, branches: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """Loans with their customer and their branch's geography.

    Setting listed keys apart reads ``loans`` once for them and once for the rest, so it is best a scan.
    """
    hot = hot or {}
    person = customers.select("customer_id", "customer_name", "credit_score", "annual_income")
    place = branches.select("branch_id", "branch_name", "city", "state", "region")
    df = lookup_join(loans, place, "branch_id", hot.get("branch_id", ()))
    return lookup_join(df, person, "customer_id", hot.get("customer_id", ()))


def loan_default_risk(
    book: DataFrame, customers: DataFrame, branches: DataFrame, hot: Hot | None = None
) -> DataFrame:
    """One row per loan of the book with its customer, its branch's geography and its risk."""
    return scored(located(book, customers, branches, hot))


def scored(book: DataFrame) -> DataFrame:
    """The risk of each loan of a located book."""
    rated = book.withColumns(
        {
            "collection_rate": safe_pct("total_amount_paid", "total_emi_due"),
            "risk_score": risk.loan_risk_score(),
        }
    )
    return rated.withColumn("risk_category", risk.risk_band("risk_score")).select(
        *LOAN_COLUMNS, "npa_records"
    )


def portfolio_kpis(loan_risk: DataFrame, kpi_date: Column | None = None) -> DataFrame:
    """The whole portfolio as one row; it exists for an empty portfolio, too.

    ``loan_risk`` has one row per loan, so loans are counted as rows; only customers need a
    distinct count.
    """
    risky = F.when(F.col("risk_category").isin("HIGH", "CRITICAL"), 1).otherwise(0)
    totals = loan_risk.agg(
        F.count("loan_id").alias("total_loans"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("loan_amount").alias("total_loan_portfolio"),
        F.sum("total_emi_due").alias("total_emi_due"),
        F.sum("total_amount_paid").alias("total_amount_collected"),
        F.sum("total_overdue_amount").alias("total_overdue_amount"),
        *status_counts(
            "loan_status",
            {"ACTIVE": "active_loans", "CLOSED": "closed_loans", "DEFAULTED": "defaulted_loans"},
        ),
        F.sum(risky).alias("high_risk_loans"),
        F.round(F.avg("risk_score"), 2).alias("avg_risk_score"),
    )
    return totals.select(
        "*",
        safe_pct("total_amount_collected", "total_emi_due").alias("collection_rate"),
        safe_pct("defaulted_loans", "total_loans").alias("default_rate"),
        safe_pct("high_risk_loans", "total_loans").alias("high_risk_loan_rate"),
        (F.current_date() if kpi_date is None else kpi_date).alias("kpi_date"),
    )


def branch_risk_summary(loan_risk: DataFrame) -> DataFrame:
    """Overdue and NPA exposure of each branch that has loans."""
    totals = loan_risk.groupBy("branch_id", "branch_name", "city", "state", "region").agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.sum("loan_amount").alias("total_disbursed_amount"),
        F.sum("total_overdue_amount").alias("total_overdue_amount"),
        F.sum("has_npa_flag").alias("npa_loans"),
        F.max("max_days_past_due").alias("max_days_past_due"),
        F.sum("total_emi_due").alias("_due"),
        F.sum("total_amount_paid").alias("_paid"),
        F.sum(F.when(F.col("loan_status") == "DEFAULTED", 1).otherwise(0)).alias("_defaulted"),
    )
    rated = totals.withColumns(
        {
            "overdue_rate": safe_pct("total_overdue_amount", "total_disbursed_amount"),
            "npa_rate": safe_pct("npa_loans", "total_loans"),
            "collection_rate": safe_pct("_paid", "_due"),
            "default_rate": safe_pct("_defaulted", "total_loans"),
        }
    )
    return rated.withColumn("branch_health_status", risk.branch_health()).drop(
        "_due", "_paid", "_defaulted"
    )


def npa_summary(loan_risk: DataFrame) -> DataFrame:
    """NPA and overdue exposure per region and loan type."""
    npa = F.col("has_npa_flag") == 1
    return (
        loan_risk.groupBy("region", "loan_type")
        .agg(
            F.count(F.lit(1)).alias("total_loans"),
            F.sum("has_npa_flag").alias("npa_loans"),
            F.sum(F.when(npa, F.col("loan_amount")).otherwise(0)).alias("npa_amount"),
            F.sum("total_overdue_amount").alias("total_overdue_amount"),
        )
        .select("*", safe_pct("npa_loans", "total_loans").alias("npa_rate"))
    )


def customer_risk_score(loan_risk: DataFrame) -> DataFrame:
    """Worst and exposure-weighted loan score per borrower, banded by the worst loan."""
    scores = loan_risk.groupBy("customer_id").agg(
        F.max("risk_score").alias("max_risk_score"),
        F.sum(F.col("risk_score") * F.col("loan_amount").cast("bigint")).alias("_weighted"),
        F.sum("loan_amount").alias("total_loan_amount"),
    )
    return scores.select(
        "customer_id",
        "max_risk_score",
        F.round(F.coalesce(F.try_divide("_weighted", "total_loan_amount"), F.lit(0.0)), 2).alias(
            "exposure_weighted_score"
        ),
        "total_loan_amount",
        risk.risk_band("max_risk_score").alias("risk_category"),
    )


class GoldLayer:
    """Gold tables over the Silver layer.

    The loan-level result is saved once and every other loan-based mart rolls it up, so payments are
    reduced to loans a single time. It keeps ``npa_records`` for the branch mart on top of the
    published loan columns.
    """

    def __init__(
        self,
        silver: SilverLayer,
        save: Callable[[str, Callable[[], DataFrame]], DataFrame],
        kpi_date: Column | None = None,
    ):
        self._silver = silver
        self._save = save
        self._kpi_date = kpi_date

    def loan_payments(self) -> DataFrame:
        return rollups.loan_payments(self._silver.table("emi_payments"))

    def loan_delinquency(self) -> DataFrame:
        return rollups.loan_delinquency(self._silver.table("delinquency"))

    def loan_risk(self) -> DataFrame:
        return self._save("loan_risk", self._build_loan_risk)

    def _build_loan_risk(self) -> DataFrame:
        self._silver.build(*LOAN_SOURCES)
        loans = self._silver.table("loan_accounts").select(*SOURCES["loan_accounts"].columns)
        # Lookups first, on the scan: after the joins by loan, those would be repeated for listed keys.
        found = located(
            loans,
            self._silver.table("customers"),
            self._silver.table("branch_master"),
            self._silver.hot("loan_accounts"),
        )
        return scored(rollups.loan_book(found, self.loan_payments(), self.loan_delinquency()))

    def customer_loan_summary(self) -> DataFrame:
        return customer_loan_summary(self._silver.table("customers"), self.loan_risk())

    def branch_performance_summary(self) -> DataFrame:
        return branch_performance_summary(self._silver.table("branch_master"), self.loan_risk())

    def monthly_collection_summary(self) -> DataFrame:
        return rollups.monthly_collection(self._silver.payments_by_type())

    def loan_default_risk_summary(self) -> DataFrame:
        return self.loan_risk().select(*LOAN_COLUMNS)

    def portfolio_kpis(self) -> DataFrame:
        return portfolio_kpis(self.loan_risk(), self._kpi_date)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customer_loan_summary": self.customer_loan_summary(),
            "branch_performance_summary": self.branch_performance_summary(),
            "monthly_collection_summary": self.monthly_collection_summary(),
            "loan_default_risk_summary": self.loan_default_risk_summary(),
            "portfolio_kpis": self.portfolio_kpis(),
        }

    def planned_tables(self) -> dict[str, DataFrame]:
        loan_risk = self.loan_risk()
        return {
            "branch_risk_summary": branch_risk_summary(loan_risk),
            "npa_summary": npa_summary(loan_risk),
            "customer_risk_score": customer_risk_score(loan_risk),
        }
