"""Helpers for functions that run over Arrow batches inside tasks, and for keys of rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text handled at once inside a task, in bytes; single longer texts are still taken whole.
SLICE_BYTES = 4_000_000

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULTS = ("64MB", "67108864", "67108864b")


def bounded_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches between Spark and Python small, unless the session set their size itself.

    Spark's own limits fit narrow rows; of whole texts a task would hold several copies of 64 MB at once.
    """
    if spark.conf.get(BATCH_BYTES) in BATCH_DEFAULTS:
        spark.conf.set(BATCH_BYTES, SLICE_BYTES)


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose strings in ``column`` hold about ``limit`` bytes."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * limit / max(batch.column(column).nbytes, 1)))
        for at in range(0, n, step):
            yield batch.slice(at, min(step, n - at))
    # A worker lives on through later stages; what Arrow holds in reserve for this one is of no use to them.
    pa.default_memory_pool().release_unused()


def texts_of(column: pa.Array) -> list[str]:
    """The strings of a column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns as one struct, so that added columns cannot clash with the input's names."""
    return df.select(F.struct(*(df[f"`{c}`"] for c in df.columns)).alias(name)) if df.columns else df


def unpacked(df: DataFrame, columns: Iterable[str], name: str = "_row") -> list[Column]:
    return [F.col(name).getField(c).alias(c) for c in columns]
