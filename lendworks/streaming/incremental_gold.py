"""Gold kept up to date from the Silver buckets that a load rewrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lendworks.config import LakeConfig
from lendworks.operators.rollups import PAYMENT_STATUS, PAYMENT_TOTALS, due_month, monthly_from_loans
from lendworks.operators.skew import heavy_keys
from lendworks.operators.validate import ACCEPTED, accepted
from lendworks.plans.gold import GoldLayer
from lendworks.sources.registry import SOURCES
from lendworks.staging import Stage
from lendworks.streaming.buckets import BUCKETS, BucketedTable
from lendworks.streaming.incremental import IncrementalSilver

PAYMENT = ("emi_amount", "paid_amount", "payment_status")
PAYMENT_SUMS = ", ".join(f"{c} bigint" for c in PAYMENT_TOTALS)
DELINQUENCY = ("days_past_due", "overdue_amount", "npa_flag")
DELINQUENCY_SUMS = ("n_reports", "total_overdue_amount", "npa_records")


def changed_rows(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Accepted rows that went, with ``_sign`` -1, and that came, with 1; rows in both cancel out."""
    was, now = (r.filter(ACCEPTED).select(*columns, F.lit(s).alias("_sign")) for r, s in ((before, -1), (after, 1)))
    net = was.unionByName(now).groupBy(*columns).agg(F.sum("_sign").alias("_sign"))
    return net.filter("_sign <> 0")


def _payment_changes() -> list[Column]:
    counts = {status: F.sum(F.when(F.col("payment_status") == status, F.col("_sign")).otherwise(0)) for status in PAYMENT_STATUS}
    return [
        F.sum("_sign").alias("total_emi_records"),
        F.sum(F.col("emi_amount") * F.col("_sign")).alias("total_emi_due"),
        F.sum(F.col("paid_amount") * F.col("_sign")).alias("total_amount_paid"),
        *(counts[status].alias(name) for status, name in PAYMENT_STATUS.items()),
    ]


class _Layer:
    """What GoldLayer asks of Silver, from the records of the last load."""

    def __init__(self, silver: IncrementalSilver):
        self._silver = silver
        self._hot: dict[str, dict[str, list]] = {}

    def build(self, *sources: str) -> None:
        """Nothing is left to save; a load has written all records."""

    def records(self, source: str) -> DataFrame:
        return self._silver.tables[source].read()

    def table(self, source: str) -> DataFrame:
        return accepted(self.records(source))

    def hot(self, source: str) -> dict[str, list]:
        if source not in self._hot:
            self._hot[source] = heavy_keys(self.records(source), list(SOURCES[source].references))
        return self._hot[source]


class IncrementalGold(GoldLayer):
    """Gold marts over totals that each load moves by what its Silver buckets lost and gained.

    Payments and delinquency reports are kept as totals per loan, payments also per month, type and loan. A load
    compares the Silver buckets rewritten since the totals' last version with what they held then: rows that went are
    subtracted, rows that came are added. Sums and counts need no more. The largest number of days past due is read
    again from the reports of just the loans that lost a report as late as that; the marts are rolled up from loans.

    The totals lie in buckets of the loan id, and their versions name the Silver versions they hold, so a load that
    failed anywhere is made up by the next one. Silver must keep those versions: expire both through ``expire``.
    """

    def __init__(self, spark: SparkSession, cfg: LakeConfig, silver: IncrementalSilver, buckets: int = BUCKETS):
        super().__init__(_Layer(silver), Stage(spark).table, cfg.today())
        self._spark, self._source = spark, silver

        def table(name: str, kinds: str) -> BucketedTable:
            schema = StructType.fromDDL(kinds)
            return BucketedTable(spark, cfg.zone("incremental", f"gold/{name}"), schema, "loan_id", buckets)

        self.payments = table("loan_payments", f"loan_id string, {PAYMENT_SUMS}")
        self.months = table("month_payments", f"loan_id string, emi_due_month string, loan_type string, {PAYMENT_SUMS}")
        self.reports = table(
            "loan_delinquency",
            "loan_id string, n_reports bigint, total_overdue_amount bigint, npa_records bigint, max_days_past_due int",
        )

    def load(self) -> None:
        """Bring the totals to the last version of Silver."""
        self._fold(self.payments, "emi_payments", [*PAYMENT, "loan_id"], self._payments_of)
        self._fold(self.months, "emi_payments", [*PAYMENT, "loan_id", "emi_due_date", "parent_loan_type"], self._months_of)
        self._fold(self.reports, "delinquency", [*DELINQUENCY, "loan_id"], self._reports_of)
        self._save = Stage(self._spark).table  # marts are built anew

    def _fold(self, totals: BucketedTable, source: str, columns: list[str], move: Callable) -> None:
        silver = self._source.tables[source]
        number, held = totals.last()
        now = silver.last()[0]
        since = int(held or 0)
        rewritten = silver.changed_since(since, now)
        if not rewritten:
            return
        changes = changed_rows(silver.read(rewritten, since), silver.read(rewritten, now), columns)
        changes = Stage(self._spark).table("changes", lambda: changes)
        touched = totals.buckets_of(changes)
        if touched:
            totals.write(move(totals.read(touched, number), changes), number + 1, str(now))

    def _payments_of(self, old: DataFrame, changes: DataFrame) -> DataFrame:
        moved = changes.groupBy("loan_id").agg(*_payment_changes())
        return old.unionByName(moved).groupBy("loan_id").agg(*(F.sum(c).alias(c) for c in PAYMENT_TOTALS))

    def _months_of(self, old: DataFrame, changes: DataFrame) -> DataFrame:
        keys = ["loan_id", "emi_due_month", "loan_type"]
        dated = changes.withColumn("emi_due_month", due_month()).withColumnRenamed("parent_loan_type", "loan_type")
        moved = dated.groupBy(*keys).agg(*_payment_changes())
        return old.unionByName(moved).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in PAYMENT_TOTALS))

    def _reports_of(self, old: DataFrame, changes: DataFrame) -> DataFrame:
        came, went = F.col("_sign") > 0, F.col("_sign") < 0
        npa = F.when(F.col("npa_flag") == "Y", F.col("_sign")).otherwise(0)
        moved = changes.groupBy("loan_id").agg(
            F.sum("_sign").alias("n_reports"),
            F.sum(F.col("overdue_amount") * F.col("_sign")).alias("total_overdue_amount"),
            F.sum(npa).alias("npa_records"),
            F.max(F.when(came, F.col("days_past_due"))).alias("max_days_past_due"),
            F.max(F.when(went, F.col("days_past_due"))).alias("_went"),
        )
        was = old.withColumn("_was", F.col("max_days_past_due")).withColumn("_went", F.lit(None).cast("int"))
        both = was.unionByName(moved.withColumn("_was", F.lit(None).cast("int")))
        merged = both.groupBy("loan_id").agg(
            *(F.sum(c).alias(c) for c in DELINQUENCY_SUMS),
            *(F.max(c).alias(c) for c in ("max_days_past_due", "_was", "_went")),
        )
        # A report as late as the latest known has gone: the rest of that loan's reports must tell.
        stale = F.coalesce(F.col("_went") >= F.col("_was"), F.lit(False))
        lost = merged.filter(stale).select("loan_id")
        left = self._source.tables["delinquency"].read().filter(ACCEPTED).select("loan_id", "days_past_due")
        left = left.join(lost, "loan_id", "left_semi").groupBy("loan_id").agg(F.max("days_past_due").alias("_left"))
        latest = F.when(stale, F.col("_left")).otherwise(F.col("max_days_past_due")).alias("max_days_past_due")
        return merged.join(left, "loan_id", "left").select("loan_id", *DELINQUENCY_SUMS, latest)

    def loan_payments(self) -> DataFrame:
        return self.payments.read().filter("total_emi_records > 0")

    def loan_delinquency(self) -> DataFrame:
        flag = F.when(F.col("npa_records") > 0, 1).otherwise(0).alias("has_npa_flag")
        known = self.reports.read().filter("n_reports > 0")
        return known.select("loan_id", "max_days_past_due", "total_overdue_amount", flag, "npa_records")

    def monthly_collection_summary(self) -> DataFrame:
        return monthly_from_loans(self.months.read().filter("total_emi_records > 0"))

    def expire(self, keep: int = 2) -> None:
        """Delete old versions of the totals, and those of Silver that the totals no longer need."""
        held = [int(t.last()[1] or 0) for t in (self.payments, self.months)]
        needed = {"emi_payments": held, "delinquency": [int(self.reports.last()[1] or 0)]}
        for table in (self.payments, self.months, self.reports):
            table.expire(keep)
        self._source.expire(keep, needed)
