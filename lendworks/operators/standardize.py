"""Column cleansing driven by a per-source declaration, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendworks.sources.registry import SourceSpec

CLEANSERS = {
    "trim": F.trim,
    "upper": lambda c: F.upper(F.trim(c)),
    "title": lambda c: F.initcap(F.trim(c)),
    # A malformed date becomes NULL; a plain cast would abort the job under ANSI mode.
    "date": F.try_to_date,
}


def cleansed(spec: SourceSpec, column: str) -> Column:
    op = spec.cleanse.get(column)
    c = F.col(column)
    return (CLEANSERS[op](c) if op else c).alias(column)


def standardize(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Cleansed declared columns first, every other column of ``df`` (audit columns) unchanged."""
    declared = spec.columns
    rest = [c for c in df.columns if c not in declared]
    return df.select(*(cleansed(spec, c) for c in declared), *rest)
