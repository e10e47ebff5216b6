"""Small literal feeds for tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendworks.sources.raw_files import stamp_bronze, timestamp_literal
from lendworks.sources.registry import SOURCES

AS_OF = datetime(2026, 6, 30)

GOOD = {
    "branch_master": ("BR1", "Main ", "pune", "new delhi", "WEST", "2015-01-01", " y"),
    "customers": (
        "C1", " Asha Rao ", "f", "1990-02-03", "navi mumbai", "GOA", "salaried", 500000, 700,
        "2024-01-01",
    ),
    "loan_applications": (
        "A1", "C1", "BR1", "home_loan", 1000, "2024-02-01", "approved", 700, None,
    ),
    "loan_accounts": (
        "L1", "A1", "C1", "BR1", "home_loan", 1000, 8.5, 12, "2024-03-01", " active ",
    ),
    "emi_payments": ("P1", "L1", "2024-04-05", "2024-04-05", 100, 100, "paid", "upi"),
    "delinquency": ("D1", "L1", 0, 0, "n", "2024-06-30"),
}


def record(source: str, **changes) -> tuple:
    """A valid record of the source with some fields changed."""
    columns = SOURCES[source].columns
    unknown = set(changes) - set(columns)
    assert not unknown, unknown
    return tuple(changes.get(c, v) for c, v in zip(columns, GOOD[source]))


def feed(spark: SparkSession, source: str, *records: tuple, file: str = "f1.csv") -> DataFrame:
    return spark.createDataFrame(list(records), SOURCES[source].schema).withColumn(
        "source_file_name", F.lit(file)
    )


def bronze(spark, source: str, *records: tuple, file: str = "f1.csv", at: datetime = AS_OF):
    now = timestamp_literal(at)
    return stamp_bronze(
        feed(spark, source, *records, file=file), SOURCES[source], now, now.cast("date")
    )


def keys(spark, column: str, *values: str, **extra: str) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in (column, *extra))
    return spark.createDataFrame([(v, *extra.values()) for v in values], schema)


PARENTS = {
    "branch_master": {},
    "customers": {},
    "loan_applications": {"customer_id": ("C1", {}), "branch_id": ("BR1", {})},
    "loan_accounts": {"customer_id": ("C1", {}), "branch_id": ("BR1", {})},
    "emi_payments": {"loan_id": ("L1", {"loan_type": "HOME_LOAN"})},
    "delinquency": {"loan_id": ("L1", {})},
}


def parents(spark, source: str) -> dict[str, DataFrame]:
    return {c: keys(spark, c, v, **extra) for c, (v, extra) in PARENTS[source].items()}


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Memory:
    """Keeps staged frames in memory, for tests that need no files; like saved tables, they end the plan."""

    def __init__(self):
        self.saved: dict[str, DataFrame] = {}

    def table(self, name, build, partition_by=()):
        if name not in self.saved:
            df = build()
            self.saved[name] = df.sparkSession.createDataFrame(df.toArrow(), df.schema)
        return self.saved[name]
