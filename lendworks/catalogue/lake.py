"""The lakehouse over one folder of test tables, with each layer built on first use."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendworks.operators.standardize import standardize
from lendworks.config import LakeConfig
from lendworks.plans.gold import GoldLayer, stamped
from lendworks.plans.refresh import create_staging_views
from lendworks.plans.reporting import reporting_marts
from lendworks.plans.silver import SilverLayer
from lendworks.sizing import size_session, stored_bytes, tasks_for
from lendworks.sources.loan_views import BASE_TABLES, loan_views
from lendworks.sources.raw_files import read_raw, stamp_bronze, timestamp_literal
from lendworks.sources.registry import SOURCES
from lendworks.sources.tables import Release
from lendworks.staging import Stage

AS_OF = datetime(2026, 6, 30)
BATCH = "2026-06-30"

# Views that join the two largest tables. Sketches, validation and raw files read them several times each, listed
# keys apart from the others, and the join would be repeated for every such scan.
JOINED = ("loan_applications", "loan_accounts")


class Feeds(Mapping[str, DataFrame]):
    """A frame per source, made when it is first asked for."""

    def __init__(self, make: Callable[[str], DataFrame]):
        self._make = make
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, source: str) -> DataFrame:
        if source not in SOURCES:
            raise KeyError(source)
        if source not in self._made:
            self._made[source] = self._make(source)
        return self._made[source]

    def __contains__(self, source: object) -> bool:
        return source in SOURCES

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        input_bytes = stored_bytes(spark, (f"{sf_dir}/{t}.parquet" for t in BASE_TABLES))
        size_session(spark, input_bytes)
        self.tasks = tasks_for(input_bytes)
        self.stage = Stage(spark)
        self.now = timestamp_literal(AS_OF)
        self.today = F.lit(AS_OF.date().isoformat()).cast("date")
        self.raw = loan_views(spark, sf_dir)
        self.saved = Feeds(self._saved_raw)
        self.bronze = {name: self._stamped(name, df) for name, df in self.raw.items()}
        # Silver reads a feed several times: for its sketch and, listed keys apart, for each of its checks.
        self.saved_bronze = Feeds(lambda name: self._stamped(name, self.saved[name]))
        self.silver = SilverLayer(self.saved_bronze, self.stage.table, as_at=self.now)
        self.gold = GoldLayer(self.silver, self.stage.table, self.today)
        self._csv: dict[tuple[str, str], str] = {}
        self._database: str | None = None

    def _saved_raw(self, source: str) -> DataFrame:
        view = self.raw[source]
        return self.stage.table(f"raw_{source}", lambda: view) if source in JOINED else view

    def _stamped(self, source: str, rows: DataFrame) -> DataFrame:
        named = rows.select("*", F.lit(source).alias("source_file_name"))
        return stamp_bronze(named, SOURCES[source], self.now, self.today)

    def standard(self, source: str, saved: bool = False) -> DataFrame:
        """The source's standardised rows; ``saved`` for checks that read them more than once."""
        return standardize((self.saved_bronze if saved else self.bronze)[source], SOURCES[source])

    def declared(self, source: str) -> DataFrame:
        return self.standard(source).select(*SOURCES[source].columns)

    def csv_folder(self, source: str, compression: str = "gzip") -> str:
        """The source's rows as a raw CSV folder, written once by Spark.

        A file holds a task's rows, so that compressed ones need not be split. Only uncompressed ones tell by their
        size whether they hold more than the header.
        """
        if (source, compression) not in self._csv:
            target = self.stage.folder(f"raw_{compression}/{source}")
            # The CSV writer trims values by default, which would clean the data on the way.
            self.saved[source].write.mode("overwrite").options(
                header=True, compression=compression, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
            ).csv(target)
            self._csv[source, compression] = target
        return self._csv[source, compression]

    def empty_csv_folder(self, source: str) -> str:
        """A raw folder of the source whose file holds the header only."""
        target = self.stage.folder(f"raw_empty/{source}")
        self.raw[source].limit(0).coalesce(1).write.mode("overwrite").option("header", True).csv(target)
        return target

    def ingested(self, source: str) -> DataFrame:
        spec = SOURCES[source]
        rows = read_raw(self.spark, spec, self.csv_folder(source))
        return stamp_bronze(rows, spec, self.now, self.today, BATCH)

    def all_ingested(self) -> dict[str, DataFrame]:
        return {s: self.ingested(s) for s in SOURCES}

    def gold_tables(self) -> dict[str, DataFrame]:
        """All Gold tables, saved like the layers below them; the loan mart is columns of the saved loan-level result."""
        self.silver.build()
        return {
            name: df if name == "loan_default_risk_summary" else self.stage.table(f"gold_{name}", lambda df=df: df)
            for name, df in self.gold.tables().items()
        }

    def stamped_gold(self) -> dict[str, DataFrame]:
        """Gold tables as a refresh saves them, with layer and time on every row."""
        return {
            name: self.stage.table(f"stamped_{name}", lambda df=df: stamped(df, self.now))
            for name, df in self.gold_tables().items()
        }

    def published(self) -> str:
        """The database of a release made of the Gold tables, with its staging views."""
        if self._database is None:
            name = "lake_" + os.path.basename(self.sf_dir.rstrip("/")).replace(".", "_").replace("-", "_")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
            release = Release(self.spark, LakeConfig(self.stage.folder("published"), database=name))
            self.silver.build()
            # The release saves each table, as a refresh does; saved here before, it would be written once more.
            for table, df in self.gold.tables().items():
                release.save(stamped(df, self.now), "gold", table)
            release.publish()
            create_staging_views(self.spark, release.cfg)
            self._database = name
        return self._database

    def marts(self) -> dict[str, DataFrame]:
        return reporting_marts(self.gold_tables())


_LAKES: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The session's lake over ``sf_dir``; queries share its saved Silver tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, sf_dir)
    return _LAKES[key]
