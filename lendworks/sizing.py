"""Shuffle width from input size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

TARGET_BYTES = 128 * 1024 * 1024  # shuffled data per task
EXPANSION = 4  # shuffled rows against compressed columnar input
WIDTH = "spark.sql.shuffle.partitions"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


# Tables are saved partitioned by verdict. With a few writers open per task, Spark need not sort every
# task's rows by partition first; beyond that number it falls back to sorting.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
VERDICT_WRITERS = 4

# What this module set in which session; a setting that differs from it is the user's.
_ours: dict[tuple[str, str], str] = {}


def stored_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes under the paths, from file-system metadata; a missing path counts nothing."""
    total = 0
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def shuffle_width(spark: SparkSession) -> int:
    configured = int(spark.conf.get(WIDTH))
    return max(configured, int(spark.conf.get(INITIAL, None) or 0))


def _set_ours(spark: SparkSession, name: str, value: int | None, unset: str | None = None) -> None:
    """Set or, with None, take back a setting, unless the user made it; ``unset`` is the value of none."""
    key = spark.sparkContext.applicationId, name
    now = spark.conf.get(name, None)
    if now not in (unset, _ours.get(key)):
        return
    if value is None:
        if now == _ours.get(key) and now is not None:
            spark.conf.unset(name)
        _ours.pop(key, None)
    else:
        spark.conf.set(name, value)
        _ours[key] = str(value)


def tasks_for(input_bytes: int) -> int:
    """Tasks that the rows of an input are dealt over where they are shuffled whole."""
    return max(-(-input_bytes * EXPANSION // TARGET_BYTES), 1)


def size_session(spark: SparkSession, input_bytes: int) -> None:
    """Fit shuffle width and writers to the input of the coming run.

    Each run is sized anew, whatever an earlier one needed. Adaptive execution merges shuffle partitions
    that stay small. Settings the session made itself are kept, and the configured width is never lowered.
    Scan splits stay as configured: their number follows the input.
    """
    wanted = tasks_for(input_bytes)
    _set_ours(spark, INITIAL, wanted if wanted > int(spark.conf.get(WIDTH)) else None)
    _set_ours(spark, WRITERS, VERDICT_WRITERS, unset="0")
