"""Full refresh of a lakehouse: raw files to Bronze, Silver, Gold, reporting marts and checks."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendworks.config import LakeConfig
from lendworks.operators.validate import ACCEPTED, silver_columns
from lendworks.plans.checks import check_gold
from lendworks.plans.gold import LOAN_COLUMNS, GoldLayer, stamped
from lendworks.plans.reporting import STAGING_VIEWS, reporting_marts
from lendworks.plans.silver import SilverLayer
from lendworks.sizing import size_session, stored_bytes
from lendworks.sources.raw_files import CORRUPT, read_raw, row_counts, stamp_bronze
from lendworks.sources.registry import SOURCES, SourceSpec
from lendworks.sources.tables import Release, ReportingStore, publish, publish_reconcile, write_rejected_zone
from lendworks.staging import exists


class MissingFeeds(Exception):
    """Feeds have not arrived; nothing was written or published."""


@dataclass
class Refresh:
    """Readers of the written tables, by layer and bare table name."""

    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    gold: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    rejects: DataFrame
    malformed: DataFrame
    missing_sources: list[str]
    rejected_zone: str
    published: DataFrame | None = None  # per Gold table the rows sent to the reporting store and read back

    def counts(self) -> DataFrame:
        tables = {f"bronze_{n}": df for n, df in self.bronze.items()}
        tables |= {f"silver_{n}": df for n, df in self.silver.items()}
        tables["silver_rejected_records"] = self.rejects
        tables |= {f"gold_{n}": df for n, df in self.gold.items()}
        return row_counts(tables | self.marts)

    def checks(self) -> DataFrame:
        return check_gold(self.gold, self.marts)


def _bronze_rows(spark: SparkSession, cfg: LakeConfig, spec: SourceSpec, arrived: bool, on_missing: str) -> DataFrame:
    """The source's rows with the text of malformed lines; those of the last release if its folder is missing."""
    published = cfg.table("bronze", spec.name)
    if not arrived and on_missing == "keep" and spark.catalog.tableExists(published):
        return spark.table(published).withColumn(CORRUPT, F.lit(None).cast("string"))
    if arrived:
        raw = read_raw(spark, spec, cfg.raw(spec.name), keep_corrupt=True)
    else:
        raw = spark.createDataFrame([], spec.schema.add(CORRUPT, "string")).selectExpr("*", "'' AS source_file_name")
    stamped_rows = stamp_bronze(raw.drop(CORRUPT), spec, cfg.now(), cfg.today(), cfg.batch_id).columns
    return stamp_bronze(raw, spec, cfg.now(), cfg.today(), cfg.batch_id).select(*stamped_rows, CORRUPT)


def load_bronze(release: Release, missing: list[str], on_missing: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """All Bronze tables, and the malformed lines of all feeds with the file and record they belong to."""
    spark, cfg = release.spark, release.cfg

    def load(spec: SourceSpec) -> DataFrame:
        rows = _bronze_rows(spark, cfg, spec, spec.name not in missing, on_missing)
        return release.save(rows, "bronze", spec.name, hidden=(CORRUPT,))

    with ThreadPoolExecutor(len(SOURCES)) as pool:
        saved = dict(zip(SOURCES, pool.map(load, SOURCES.values())))
    parts = [
        ([f"'{n}' AS source", "source_file_name", f"`{SOURCES[n].key}` AS record_id", f"{CORRUPT} AS line"], ("bronze", n), f"{CORRUPT} IS NOT NULL")
        for n in saved
    ]
    malformed = release.view("bronze", "malformed_lines", parts)
    return {n: df.drop(CORRUPT) for n, df in saved.items()}, malformed


def _saver(release: Release, finish: Callable[[DataFrame], DataFrame] = lambda df: df):
    """Write each named work table on first request, then hand out its reader."""
    saved: dict[str, DataFrame] = {}

    def save(name, build, partition_by=()):
        if name not in saved:
            saved[name] = release.save(finish(build()), "work", name, partition_by)
        return saved[name]

    return save


def silver_tables(release: Release, silver: SilverLayer) -> dict[str, DataFrame]:
    """Silver tables: the accepted partition of each validated table."""

    def columns(source: str) -> list[str]:
        return [
            "'SILVER' AS pipeline_layer" if c == "pipeline_layer" else f"`{c}`"
            for c in silver_columns(silver.validated(source))
        ]

    # Folder names are text to a view.
    return {s: release.view("silver", s, [(columns(s), ("work", f"validated_{s}"), f"{ACCEPTED} = 'true'")]) for s in SOURCES}


def gold_tables(release: Release, layer: GoldLayer) -> dict[str, DataFrame]:
    """Gold tables; the loan mart is a view on the saved loan-level result."""

    def save(name: str, df: DataFrame) -> DataFrame:
        if name != "loan_default_risk_summary":
            return release.save(stamped(df, release.cfg.now()), "gold", name)
        columns = [*LOAN_COLUMNS, "gold_processed_timestamp", "pipeline_layer"]
        return release.view("gold", name, [(columns, ("work", "loan_risk"), None)])

    tables = layer.tables() | layer.planned_tables()
    with ThreadPoolExecutor(len(tables)) as pool:
        return dict(zip(tables, pool.map(save, tables, tables.values())))


def create_staging_views(spark: SparkSession, cfg: LakeConfig) -> None:
    """Staging views on the published Gold views; the same text each time, what they show follows the release."""
    for view, table in STAGING_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {cfg.database}.{view} AS SELECT * FROM {cfg.table('gold', table)}")


def refresh(
    spark: SparkSession, cfg: LakeConfig, on_missing: str = "stop", store: ReportingStore | None = None
) -> Refresh:
    """Build a release from all raw files and publish it; with a ``store`` send the Gold tables there and reconcile.

    ``on_missing`` says what a feed without a folder means: ``stop`` raises before anything is written,
    ``keep`` goes on with the feed's rows of the last release, ``empty`` takes the feed as empty. Published
    views change only after every table is written.
    """
    size_session(spark, stored_bytes(spark, [cfg.zone("raw")]))
    missing = [s for s in SOURCES if not exists(spark, cfg.raw(s))]
    if missing and on_missing == "stop":
        raise MissingFeeds(", ".join(missing))
    release = Release(spark, cfg)
    bronze, malformed = load_bronze(release, missing, on_missing)

    silver_layer = SilverLayer(bronze, _saver(release), cfg.null_policy, cfg.now())
    silver_layer.build()
    silver = silver_tables(release, silver_layer)
    rejects = release.save(silver_layer.all_rejects(), "silver", "rejected_records")
    rejected_zone = release.path("rejected", "")
    write_rejected_zone(rejects, rejected_zone)

    save_stamped = _saver(release, lambda df: stamped(df, cfg.now()))
    gold_layer = GoldLayer(silver_layer, save_stamped, cfg.today())
    gold = gold_tables(release, gold_layer)
    marts = {n: release.save(df, "reporting", n) for n, df in reporting_marts(gold).items()}
    release.publish()
    create_staging_views(spark, cfg)
    reconciled = None
    if store is not None:
        sent = {f"gold_{n}": df for n, df in gold.items()}
        reconciled = publish_reconcile(publish(sent, store), store, list(sent))
    return Refresh(bronze, silver, gold, marts, rejects, malformed, missing, rejected_zone, reconciled)
