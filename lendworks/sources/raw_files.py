"""Raw CSV folders to audited Bronze rows, and checks on what arrived."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from lendworks.sources.registry import SOURCES, SourceSpec
from lendworks.staging import exists

CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, spec: SourceSpec, folder: str, keep_corrupt: bool = False) -> DataFrame:
    """All CSV files of a folder under the declared schema, with the file each row came from.

    A malformed value becomes NULL and surfaces later as a rule violation. ``keep_corrupt`` adds the
    text of malformed lines as a column.
    """
    schema = spec.schema.add(CORRUPT, StringType()) if keep_corrupt else spec.schema
    reader = spark.read.schema(schema).options(header=True, mode="PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return with_source_file(reader.csv(folder))


def malformed_lines(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """``source, source_file_name, record_id, line`` of rows written with the text of malformed lines.

    Straight from CSV files, columns that nobody reads would not be parsed and their faults not seen.
    """
    return rows.filter(F.col(CORRUPT).isNotNull()).select(
        F.lit(spec.name).alias("source"), "source_file_name", F.col(spec.key).alias("record_id"), F.col(CORRUPT).alias("line")
    )


def with_source_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("source_file_name"))


def stamp_bronze(
    df: DataFrame,
    spec: SourceSpec,
    now: Column | None = None,
    today: Column | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Add the Bronze audit columns to rows that already carry ``source_file_name``."""
    audit = {
        "ingestion_timestamp": F.current_timestamp() if now is None else now,
        "load_date": F.current_date() if today is None else today,
        "pipeline_layer": F.lit("BRONZE"),
        "source_system": F.lit(spec.system),
    }
    if batch_id is not None:
        audit["batch_id"] = F.lit(batch_id)
    return df.withColumns(audit)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for every table, as one query."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def audit_rollup(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("pipeline_layer", "source_system").agg(
        F.count(F.lit(1)).alias("record_count")
    )


def audit_presence(bronze: DataFrame) -> DataFrame:
    """Per layer and source: rows, and rows whose audit columns are all filled."""
    filled = reduce(
        lambda a, b: a & b,
        (
            F.col(c).isNotNull()
            for c in ("source_file_name", "ingestion_timestamp", "load_date", "batch_id")
        ),
    )
    return bronze.groupBy("pipeline_layer", "source_system", "batch_id").agg(
        F.count(F.lit(1)).alias("record_count"), F.count_if(filled).alias("audited_count")
    )


# Fixed value: how a day's files are named.
DAY_FILE = "{source}_{day:%Y_%m_%d}.csv"

ARRIVED, EMPTY, MISSING, UNEXPECTED = "arrived", "empty", "missing", "unexpected"


def file_listing(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """``source, file, bytes, modified`` of the files in each source's folder, from metadata alone.

    The scan lists paths and never opens a file; a folder that does not exist has no files. Scans pass files without
    a byte by, so those are taken from the names that Spark's file index holds anyway.
    """
    found = [spark.createDataFrame([], "source string, file string, bytes bigint, modified timestamp")]
    for source, folder in folders.items():
        if not exists(spark, folder):
            continue
        files = spark.read.format("binaryFile").load(folder)
        names = [(source, unquote(f.rpartition("/")[2])) for f in files.inputFiles()]
        listed = spark.createDataFrame(names, "source string, file string")
        name = F.element_at(F.split("path", "/"), -1).alias("file")
        sized = files.select(name, F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
        both = listed.join(sized, "file", "left")
        found.append(both.select("source", "file", F.coalesce("bytes", F.lit(0)).alias("bytes"), "modified"))
    return reduce(lambda a, b: a.unionByName(b), found)


def day_files(day: date) -> dict[str, str]:
    """The file expected of every source on a day."""
    return {s: DAY_FILE.format(source=s, day=day) for s in SOURCES}


def header_bytes(spec: SourceSpec) -> int:
    """Bytes of a file that holds the header line at most."""
    return len(",".join(spec.columns)) + 2


def file_arrival(spark: SparkSession, folders: Mapping[str, str], expected: Mapping[str, str]) -> DataFrame:
    """``source, file, bytes, status``: what came of the expected files, by metadata alone.

    ``expected`` has a name pattern (SQL LIKE) per source. A file of that name ``arrived``, or is ``empty`` if it holds
    no more than a header; a source with no such file is ``missing``, and a file of another name ``unexpected``.
    """
    rows = [(s, expected[s], header_bytes(SOURCES[s])) for s in SOURCES if s in expected]
    wanted = F.broadcast(spark.createDataFrame(rows, "source string, pattern string, header bigint"))  # a row a source
    files = file_listing(spark, {s: folders[s] for s in folders if s in expected})
    named = files.join(wanted, "source").withColumn("fits", F.expr("file LIKE pattern"))
    status = F.when(~F.col("fits"), UNEXPECTED).when(F.col("bytes") <= F.col("header"), EMPTY).otherwise(ARRIVED)
    came = named.select("source", "file", "bytes", status.alias("status"))
    none = wanted.join(named.filter("fits").select("source").distinct(), "source", "left_anti")
    missing = none.select("source", F.col("pattern").alias("file"), F.lit(0).cast("bigint").alias("bytes"), F.lit(MISSING).alias("status"))
    return came.unionByName(missing)


def source_arrival(spark: SparkSession, bronze: Mapping[str, DataFrame], arrivals: DataFrame | None = None) -> DataFrame:
    """One row per expected source: files and rows that arrived, and whether it is missing.

    A source without any data frame is reported, not raised. Whether a source is missing follows from its files
    where ``arrivals`` of ``file_arrival`` are given: an empty file has arrived. Else no rows count as missing.
    """
    expected = spark.createDataFrame([(s,) for s in SOURCES], "source string")
    arrived = [
        df.groupBy("source_file_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))
        .select(F.lit(name).alias("source"), "files", "rows")
        for name, df in bronze.items()
    ]
    empty = spark.createDataFrame([], "source string, files bigint, rows bigint")
    found = reduce(lambda a, b: a.unionByName(b), arrived, empty)
    # Both sides hold one row per source, at most the size of the registry.
    counted = expected.join(F.broadcast(found), "source", "left").select(
        "source", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("rows", F.lit(0)).alias("rows")
    )
    if arrivals is None:
        return counted.withColumn("is_missing", F.col("rows") == 0)
    listed = arrivals.filter(F.col("status").isin(ARRIVED, EMPTY)).groupBy("source").agg(F.count(F.lit(1)).alias("listed"))
    both = counted.join(F.broadcast(listed), "source", "left")
    files = F.coalesce("listed", F.lit(0))
    return both.select("source", files.alias("files"), "rows", (files == 0).alias("is_missing"))


# Rows expected from one day's sample, and the tolerance where the count is approximate.
EXPECTED_VOLUME = {
    "branch_master": (15, 0.0),
    "customers": (202, 0.0),
    "loan_applications": (300, 0.0),
    "loan_accounts": (214, 0.05),
    "emi_payments": (1286, 0.05),
    "delinquency": (199, 0.05),
}


def volume_check(
    spark: SparkSession,
    counts: DataFrame,
    expected: Mapping[str, tuple[int, float]] | None = None,
) -> DataFrame:
    """Expected against actual rows; ``counts`` comes from ``row_counts`` keyed by source name."""
    rows = [(s, n, tol) for s, (n, tol) in (expected or EXPECTED_VOLUME).items()]
    wanted = spark.createDataFrame(rows, "source string, expected_rows bigint, tolerance double")
    actual = F.coalesce("row_count", F.lit(0))
    off = F.abs(actual - F.col("expected_rows"))
    return wanted.join(counts.withColumnRenamed("table_name", "source"), "source", "left").select(
        "source",
        "expected_rows",
        actual.alias("actual_rows"),
        (off <= F.col("expected_rows") * F.col("tolerance")).alias("within_expectation"),
    )


def timestamp_literal(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")
