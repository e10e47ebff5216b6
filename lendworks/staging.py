"""Written intermediate tables.

A staged table cuts lineage: later jobs read columnar files instead of recomputing the plan, and a
lost executor costs a re-read, not a re-run. Files go under the folder the cluster names in
``spark.checkpoint.dir``, which all executors share.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; if there is none, one in the warehouse, which is shared as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    if warehouse.startswith("file:") and not local:
        raise ValueError("set spark.checkpoint.dir, or a warehouse that all executors share, for intermediate tables")
    return warehouse + "/_staging"


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, fs = _located(spark, folder)
    return fs.exists(path)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def delete(spark: SparkSession, folder: str) -> None:
    path, fs = _located(spark, folder)
    fs.delete(path, True)


class Stage:
    """Named parquet tables in a run-private subfolder, each written once and then re-read."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        root = folder or shared_folder(spark)
        self.path = f"{root}/lendworks-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
        self._tables: dict[str, DataFrame] = {}
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(target)
        fs.deleteOnExit(target)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def table(
        self, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()
    ) -> DataFrame:
        if name not in self._tables:
            df = build()
            target = self.folder(name)
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
            # Declaring the schema skips footer inference and keeps partition column types.
            self._tables[name] = self.spark.read.schema(df.schema).parquet(target).select(*df.columns)
        return self._tables[name]
