"""Reusable measure expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def safe_pct(part: str | Column, whole: str | Column) -> Column:
    """``part`` as a percentage of ``whole`` to two decimals; 0 when ``whole`` is 0 or NULL."""
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def status_counts(column: str, names: Mapping[str, str]) -> list[Column]:
    """One row count per listed value, named as given; NULL over an empty global group."""
    c = F.col(column)
    return [F.sum(F.when(c == v, 1).otherwise(0)).alias(n) for v, n in names.items()]


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs left by an outer join become 0 in the named numeric columns only."""
    return df.fillna(0, subset=list(columns))
