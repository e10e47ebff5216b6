"""Table writes, and publishing to a reporting store with reconciliation."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from lendworks.config import LakeConfig
from lendworks.staging import delete, exists, subfolders


class Release:
    """One run's tables: each written once into the run's own partition, all published by one write at the end.

    The files of a table lie in a folder per release. Published names are catalog views of the release that the
    pointer, a table of the releases published so far, names last: ``release = (SELECT max(release) FROM pointer)``,
    which prunes to that folder. Adding a line to the pointer therefore switches all tables at once; a reader sees
    one release in all of them, before as after, and a run that fails on the way changes nothing that is read. Views
    are made anew only where a table is new or its columns changed, before the switch. Files of a release are never
    rewritten; ``expire`` deletes those of old releases. The table format must be one of Spark's file formats.
    """

    MARK = "release="
    LAYERS = ("bronze", "silver", "gold", "reporting", "work", "rejected")

    def __init__(self, spark: SparkSession, cfg: LakeConfig):
        self.spark, self.cfg = spark, cfg
        self.version = f"r{time.time_ns():020d}"  # a letter first, so that it stays text
        self.pointer = cfg.zone("releases")
        self._schemas: dict[tuple[str, str], StructType] = {}
        self._views: dict[str, str] = {}

    def path(self, layer: str, name: str) -> str:
        return f"{self.cfg.zone(layer, name).rstrip('/')}/{self.MARK}{self.version}"

    def save(
        self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (), hidden: Sequence[str] = ()
    ) -> DataFrame:
        """Write a table and return its reader; work tables are not published, ``hidden`` columns neither."""
        path, kind = self.path(layer, name), self.cfg.table_format
        df.write.format(kind).partitionBy(*partition_by).save(path)
        if partition_by:
            # Without rows there would be no file that tells the columns.
            folders = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in partition_by)
            none = self.spark.createDataFrame([], df.drop(*partition_by).schema)
            none.write.format(kind).save(f"{path}/{folders}")
        self._schemas[layer, name] = df.schema
        if layer != "work":
            self.view(layer, name, [([f"`{c}`" for c in df.columns if c not in hidden], (layer, name), None)])
        return self.read(layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        """A table of this release, published or not."""
        schema = self._schemas[layer, name]
        stored = self.spark.read.schema(schema).format(self.cfg.table_format).load(self.path(layer, name))
        return stored.select(*schema.fieldNames())

    def view(self, layer: str, name: str, parts: Sequence[tuple[Sequence[str], tuple[str, str], str | None]]) -> DataFrame:
        """Publish ``(columns, (layer, table), condition)`` of saved tables, one below the other, later; read it now."""
        kind = self.cfg.table_format
        current = f"(SELECT max(release) FROM {kind}.`{self.pointer}`)"
        selects, frames = [], []
        for columns, source, condition in parts:
            where = f" AND {condition}" if condition else ""
            selects.append(f"SELECT {', '.join(columns)} FROM {kind}.`{self.cfg.zone(*source)}` WHERE release = {current}{where}")
            frame = self.read(*source)
            frames.append((frame.filter(condition) if condition else frame).selectExpr(*columns))
        self._views[self.cfg.table(layer, name)] = " UNION ALL ".join(selects)
        return reduce(lambda a, b: a.unionByName(b), frames)

    def _view_text(self, name: str) -> str | None:
        if not self.spark.catalog.tableExists(name):
            return None
        rows = self.spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'View Text'").collect()
        return rows[0]["data_type"] if rows else None

    def _switch(self) -> None:
        line = self.spark.createDataFrame([(self.version,)], "release string").coalesce(1)
        line.write.format(self.cfg.table_format).mode("append").save(self.pointer)

    def publish(self) -> None:
        first = not exists(self.spark, self.pointer)
        if first:
            self._switch()  # views need something to point at
        for name, select in self._views.items():
            if self._view_text(name) != select:
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")
        if not first:
            self._switch()

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the files of releases older than the last ``keep`` published ones; returns the deleted folders."""
        if not exists(self.spark, self.pointer):
            return []
        published = self.spark.read.format(self.cfg.table_format).load(self.pointer)
        kept = [r["release"] for r in published.distinct().orderBy(F.desc("release")).limit(max(keep, 1)).collect()]
        dropped = []
        for layer in self.LAYERS:
            tables = ["", *subfolders(self.spark, self.cfg.zone(layer))]
            for table in tables:
                base = self.cfg.zone(layer, table)
                for folder in subfolders(self.spark, base):
                    if folder.startswith(self.MARK) and folder.removeprefix(self.MARK) < min(kept):
                        delete(self.spark, f"{base}/{folder}")
                        dropped.append(f"{base}/{folder}")
        return dropped


def write_rejected_zone(rejects: DataFrame, path: str) -> None:
    """Rejects as files, one folder per source table and rule.

    Rebalancing brings a rule's rows together and lets adaptive execution split large rules and merge small
    ones, so the number of files follows the rows instead of tasks times rules.
    """
    dealt = rejects.hint("rebalance", "source_table", "rule_code")
    dealt.write.mode("overwrite").partitionBy("source_table", "rule_code").parquet(path)


@dataclass(frozen=True)
class ReportingStore:
    """Where published tables go: any Spark data source.

    File formats need ``path``; warehouse connectors and JDBC address the table with ``dbtable`` and
    take their connection settings from ``options``.
    """

    format: str = "parquet"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def target(self, name: str) -> str:
        return name.upper()

    def write(self, df: DataFrame, name: str) -> None:
        writer = df.write.format(self.format).mode("overwrite").options(**self.options)
        if self.path:
            writer.save(f"{self.path}/{self.target(name)}")
        else:
            writer.option("dbtable", self.target(name)).save()

    def count(self, spark: SparkSession, name: str) -> DataFrame:
        """One-row frame with the published row count, counted in the store where it can be."""
        reader = spark.read.format(self.format).options(**self.options)
        if self.path:
            stored = reader.load(f"{self.path}/{self.target(name)}")
            counted = stored.agg(F.count(F.lit(1)).alias("target_rows"))
        else:
            query = f"SELECT COUNT(*) AS row_count FROM {self.target(name)}"
            counted = reader.option("query", query).load().toDF("target_rows")
        return counted.select(
            F.lit(self.target(name)).alias("target_table"), F.col("target_rows").cast("bigint")
        )


def publish(tables: Mapping[str, DataFrame], store: ReportingStore) -> DataFrame:
    """Overwrite each table in the store; returns ``(source_table, target_table, source_rows)``.

    Tables are sent side by side, and their rows are counted as they are sent.
    """
    spark = next(iter(tables.values())).sparkSession

    def send(name: str) -> tuple[str, str, int]:
        sent = Observation(name)
        store.write(tables[name].observe(sent, F.count(F.lit(1)).alias("rows")), name)
        return name, store.target(name), sent.get.get("rows", 0)

    with ThreadPoolExecutor(len(tables)) as pool:
        rows = list(pool.map(send, tables))
    return spark.createDataFrame(rows, "source_table string, target_table string, source_rows bigint")


def publish_reconcile(published: DataFrame, store: ReportingStore, names: Sequence[str]) -> DataFrame:
    """Rows sent against rows read back from the store, per table."""
    spark = published.sparkSession
    stored = reduce(lambda a, b: a.unionByName(b), (store.count(spark, n) for n in names))
    return published.join(stored, "target_table", "left").select(
        "source_table",
        "target_table",
        "source_rows",
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        F.col("source_rows").eqNullSafe(F.col("target_rows")).alias("matches"),
    )
