"""Data expectations: each yields the rows, or the number of rows, that break it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lendworks.operators.skew import split_heavy


def duplicate_keys(df: DataFrame, column: str, hot: Iterable = (), tasks: int | None = None) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows.

    Tasks count before the shuffle, which for keys that hardly repeat means a table of nearly all their rows. With
    ``tasks`` only the heavy keys listed in ``hot`` are counted so; rows of all others are dealt by key over that many
    tasks, each of which holds its share of the keys.
    """
    keys = df.filter(F.col(column).isNotNull()).select(column)

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")

    if tasks is None:
        return counted(keys)
    hot = list(hot)
    ordinary, heavy = split_heavy(keys, column, hot)
    dealt = counted(ordinary.repartition(tasks, column))
    return dealt.unionByName(counted(heavy)) if hot else dealt


def unmatched_keys(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL values without a parent row, with their number of child rows.

    The child is reduced to one row per value before the join, so a frequent value costs nothing.
    """
    children = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    )
    parents = parent.select(F.col(parent_column).alias(column))
    return children.join(parents, column, "left_anti")


@dataclass(frozen=True)
class Expectation:
    suite: str
    model: str
    test: str
    column: str = ""
    values: tuple = ()


def _condition(e: Expectation) -> Column:
    """TRUE for a failing row, for tests decided row by row."""
    c = F.col(e.column)
    if e.test == "not_null":
        return c.isNull()
    if e.test == "accepted_values":
        return ~c.isin(*e.values)
    if e.test == "non_negative":
        return c < 0
    if e.test == "rate_range":
        return (c < e.values[0]) | (c > e.values[1])
    raise ValueError(e.test)


def failing_rows(df: DataFrame, e: Expectation) -> DataFrame:
    """The rows that a test decided row by row counts as failures."""
    return df.filter(_condition(e))


ROW_TESTS = ("not_null", "accepted_values", "non_negative", "rate_range")


def _counted(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """All row-by-row and row-count tests of one table, from a single aggregation."""
    measures = []
    for i, e in enumerate(expectations):
        if e.test == "row_count":
            measure = (F.count(F.lit(1)) != F.lit(e.values[0])).cast("bigint")
        else:
            measure = F.count_if(_condition(e))
        measures.append(measure.alias(f"m{i}"))
    labelled = F.array(
        *(
            F.struct(*_labels(e), F.col(f"m{i}").alias("failures"))
            for i, e in enumerate(expectations)
        )
    )
    return df.agg(*measures).select(F.inline(labelled))


def _labels(e: Expectation) -> list[Column]:
    return [
        F.lit(e.suite).alias("suite"),
        F.lit(e.model).alias("model"),
        F.lit(e.test).alias("test"),
        F.lit(e.column).alias("column_name"),
    ]


def _keyed(failing: DataFrame, labels: Iterable[Expectation], failures: Column) -> DataFrame:
    """Failure count of one shuffling check, reported once for each expectation it answers."""
    fan_out = F.array(*(F.struct(*_labels(e)) for e in labels))
    counted = failing.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"))
    return counted.select(F.inline(fan_out), "failures")


def run_suite(
    expectations: Sequence[Expectation],
    models: Mapping[str, DataFrame],
    same_data: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(suite, model, test, column_name, failures)``, one row per expectation; 0 is a pass.

    Tests of one table share a pass. ``same_data`` maps a model to the model it is a plain view of,
    so that a check asked of both is computed once.
    """
    same_data = same_data or {}
    by_table: dict[str, list[Expectation]] = {}
    by_check: dict[tuple, list[Expectation]] = {}
    for e in expectations:
        table = same_data.get(e.model, e.model)
        if e.test in ROW_TESTS or e.test == "row_count":
            by_table.setdefault(table, []).append(e)
        else:
            by_check.setdefault((table, e.test, e.column, e.values), []).append(e)

    results = [_counted(models[t], es) for t, es in by_table.items()]
    for (table, test, column, values), es in by_check.items():
        if test == "unique":
            failing = duplicate_keys(models[table], column)
            results.append(_keyed(failing, es, F.count(F.lit(1))))
        elif test == "relationships":
            parent, parent_column = values
            parent = models[same_data.get(parent, parent)]
            failing = unmatched_keys(models[table], column, parent, parent_column)
            results.append(_keyed(failing, es, F.sum("cnt")))
        else:
            raise ValueError(test)
    return reduce(lambda a, b: a.unionByName(b), results)
