"""Small tables that every operator must cope with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Names that operators use for what they add; inputs may hold columns of the same names.
CLASHES = "text_hash fp digest salt keep_id copy score predicted held_out token_ids decoded lines_removed component_id _row".split()

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]], source: str | None = "s") -> DataFrame:
    data = [(i, t, "en", source, None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(data, DOCS)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls, empty and blank texts, repeated rows, ties, a very long text, and clashing extra columns."""
    long_text = "\n".join(f"word{i} of a long line number {i} in the text" for i in range(3_000))
    rows = [
        (1, "One two three four five six."),
        (1, "One two three four five six."),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (None, "One two three four five six."),
        (None, None),
        (5, long_text),
        (6, "Ünïcode ñandú 日本語 \U0001f600 é   end"),
        (7, "a"),
    ]
    docs = documents(spark, rows)
    for name in CLASHES:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


def none(spark: SparkSession) -> DataFrame:
    return documents(spark, [])


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
