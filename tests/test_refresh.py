from __future__ import annotations

import os
import pathlib

import pytest

from lendworks.config import LakeConfig
from lendworks.operators.validate import rejects_by_rule
from lendworks.plans import refresh as refresh_module
from lendworks.plans.refresh import MissingFeeds, refresh
from lendworks.sources.raw_files import (
    audit_rollup,
    day_files,
    file_arrival,
    file_listing,
    read_raw,
    source_arrival,
    stamp_bronze,
    volume_check,
)
from lendworks.sources.registry import SOURCES
from lendworks.sources.tables import Release, ReportingStore, publish, publish_reconcile
from tests.helpers import AS_OF, GOOD, record, rows


def write_csv(folder, source, *records, name="day1.csv"):
    os.makedirs(f"{folder}/{source}", exist_ok=True)
    with open(f"{folder}/{source}/{name}", "w") as f:
        f.write(",".join(SOURCES[source].columns) + "\n")
        for r in records:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


@pytest.fixture(scope="module")
def lake_run(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    for source in GOOD:
        if source != "emi_payments":  # this feed has not arrived
            write_csv(f"{base}/raw", source, record(source))
    write_csv(f"{base}/raw", "customers", record("customers"), name="day2.csv")
    write_csv(
        f"{base}/raw",
        "loan_accounts",
        record("loan_accounts", loan_id="L2", loan_amount="oops"),
        record("loan_accounts", loan_id="L3", loan_status="CLOSED", customer_id="C404"),
        name="day2.csv",
    )
    cfg = LakeConfig(base, database="lake_test", as_of=AS_OF, batch_id="b1")
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_test")
    with pytest.raises(MissingFeeds, match="emi_payments"):
        refresh(spark, cfg)
    # Nothing was written; temporary views of the session belong to no database.
    assert not [t for t in spark.catalog.listTables("lake_test") if not t.isTemporary]
    return cfg, refresh(spark, cfg, on_missing="empty")


def test_all_layers_are_written(spark, lake_run):
    _, run = lake_run
    assert run.missing_sources == ["emi_payments"]
    counts = {r.table_name: r.row_count for r in run.counts().collect()}
    assert counts["bronze_customers"] == 2 and counts["silver_customers"] == 1
    assert counts["bronze_loan_accounts"] == 3 and counts["silver_loan_accounts"] == 1
    assert counts["bronze_emi_payments"] == 0 and counts["gold_monthly_collection_summary"] == 0
    assert counts["silver_rejected_records"] == 3
    assert counts["gold_portfolio_kpis"] == 1 and counts["mart_portfolio_executive_summary"] == 1
    assert spark.table("lake_test.silver_customers").count() == 1
    assert spark.table("lake_test.gold_loan_default_risk_summary").count() == 1


def test_malformed_number_becomes_a_rule_violation(lake_run):
    _, run = lake_run
    assert rows(rejects_by_rule(run.rejects).select("rule_code", "rejected_count")) == [
        ("CUST_002", 1),
        ("LOAN_003", 1),
        ("LOAN_005", 1),
    ]


def test_audit_columns(lake_run):
    _, run = lake_run
    row = run.bronze["customers"].first()
    assert row.source_file_name.endswith(".csv") and row.batch_id == "b1"
    assert (row.pipeline_layer, row.source_system) == ("BRONZE", "CUSTOMERS")
    assert str(row.load_date) == "2026-06-30"
    assert rows(audit_rollup(run.bronze["customers"])) == [("BRONZE", "CUSTOMERS", 2)]
    silver = run.silver["customers"]
    assert silver.first().pipeline_layer == "SILVER"
    assert "parent_loan_type" not in run.silver["emi_payments"].columns
    gold = run.gold["loan_default_risk_summary"].first()
    assert gold.pipeline_layer == "GOLD" and gold.gold_processed_timestamp is not None


def test_suite_passes(lake_run):
    _, run = lake_run
    results = run.checks().collect()
    assert len(results) == 35 and all(r.failures == 0 for r in results)


def test_silver_view_reads_the_accepted_partition_only(lake_run):
    _, run = lake_run
    plan = run.silver["loan_accounts"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in plan


def test_rejected_zone_is_partitioned_by_source_and_rule(spark, lake_run):
    _, run = lake_run
    target = run.rejected_zone
    assert os.path.isdir(f"{target}/source_table=bronze_loan_accounts/rule_code=LOAN_005")
    assert spark.read.parquet(target).count() == 3


def test_arrival_and_volume(spark, lake_run):
    cfg, run = lake_run
    present = {s: df for s, df in run.bronze.items() if s != "delinquency"}
    arrived = {r.source: (r.files, r.rows, r.is_missing) for r in source_arrival(spark, present).collect()}
    assert arrived["customers"] == (2, 2, False)
    assert arrived["emi_payments"] == (0, 0, True) and arrived["delinquency"] == (0, 0, True)
    assert source_arrival(spark, {}).filter("is_missing").count() == 6
    actual = spark.createDataFrame([("customers", 202), ("loan_accounts", 220)], "table_name string, row_count long")
    ok = {r.source for r in volume_check(spark, actual).filter("within_expectation").collect()}
    assert ok == {"customers", "loan_accounts"}


def test_arrival_by_file_metadata(spark, tmp_path):
    for source in ("branch_master", "customers", "loan_accounts", "emi_payments"):
        write_csv(str(tmp_path), source, *([] if source == "customers" else [record(source)]), name=f"{source}_2026_06_30.csv")
    write_csv(str(tmp_path), "emi_payments", record("emi_payments"), name="emi_payments_2026_06_29.csv")
    write_csv(str(tmp_path), "loan_applications", record("loan_applications"), name="applications.csv")
    open(f"{tmp_path}/branch_master/branch_master_2026_06_30.csv", "w").close()  # no byte at all
    folders = {s: f"{tmp_path}/{s}" for s in SOURCES}
    expected = day_files(AS_OF.date())
    found = file_arrival(spark, folders, expected)
    assert rows(found.select("source", "file", "status")) == sorted(
        [
            ("branch_master", "branch_master_2026_06_30.csv", "empty"),
            ("customers", "customers_2026_06_30.csv", "empty"),
            ("delinquency", "delinquency_2026_06_30.csv", "missing"),
            ("emi_payments", "emi_payments_2026_06_29.csv", "unexpected"),
            ("emi_payments", "emi_payments_2026_06_30.csv", "arrived"),
            ("loan_accounts", "loan_accounts_2026_06_30.csv", "arrived"),
            ("loan_applications", "applications.csv", "unexpected"),
            ("loan_applications", "loan_applications_2026_06_30.csv", "missing"),
        ],
        key=repr,
    )
    plan = file_listing(spark, folders)._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "content" not in plan  # no file is opened
    assert file_arrival(spark, {}, expected).filter("status <> 'missing'").count() == 0
    customers = read_raw(spark, SOURCES["customers"], folders["customers"]).limit(0)
    told = {r.source: (r.files, r.rows, r.is_missing) for r in source_arrival(spark, {"customers": customers}, found).collect()}
    assert told["customers"] == (1, 0, False) and told["delinquency"] == (0, 0, True) and told["loan_applications"] == (0, 0, True)


def test_corrupt_lines_can_be_kept(spark, tmp_path):
    write_csv(str(tmp_path), "customers", record("customers", credit_score="high"))
    kept = read_raw(spark, SOURCES["customers"], f"{tmp_path}/customers", keep_corrupt=True).first()
    assert kept.credit_score is None and "high" in kept["_corrupt_record"]
    plain = read_raw(spark, SOURCES["customers"], f"{tmp_path}/customers")
    assert "_corrupt_record" not in plain.columns
    assert "batch_id" not in stamp_bronze(plain, SOURCES["customers"]).columns


def test_publish_and_reconcile(spark, lake_run, tmp_path):
    _, run = lake_run
    store = ReportingStore(path=str(tmp_path))
    sent = publish({"gold_portfolio_kpis": run.gold["portfolio_kpis"]}, store)
    assert rows(sent) == [("gold_portfolio_kpis", "GOLD_PORTFOLIO_KPIS", 1)]
    assert publish_reconcile(sent, store, ["gold_portfolio_kpis"]).first().matches
    store.write(run.rejects, "gold_portfolio_kpis")
    assert not publish_reconcile(sent, store, ["gold_portfolio_kpis"]).first().matches


def test_malformed_lines_are_reported(spark, lake_run):
    _, run = lake_run
    assert [(r.source, r.record_id) for r in run.malformed.collect()] == [("loan_accounts", "L2")]
    assert "oops" in spark.table("lake_test.bronze_malformed_lines").first().line
    assert "_corrupt_record" not in spark.table("lake_test.bronze_loan_accounts").columns


def test_staging_views_are_in_the_catalog(spark, lake_run):
    _, run = lake_run
    other = spark.newSession()
    assert rows(other.table("lake_test.stg_portfolio_kpis")) == rows(run.gold["portfolio_kpis"])


def test_a_refresh_that_fails_midway_changes_no_published_table(spark, lake_run, monkeypatch):
    cfg, _ = lake_run
    before = {t: rows(spark.table(f"lake_test.{t}")) for t in ("silver_customers", "gold_portfolio_kpis", "bronze_customers")}

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(refresh_module, "gold_tables", fail)
    with pytest.raises(RuntimeError):
        refresh(spark, cfg, on_missing="empty")
    assert {t: rows(spark.table(f"lake_test.{t}")) for t in before} == before


def test_second_refresh_replaces_the_first_and_its_readers_go_on(spark, lake_run):
    cfg, first = lake_run
    write_csv(f"{cfg.base_path}/raw", "customers", record("customers", customer_id="C9"), name="day3.csv")
    old = rows(first.silver["customers"])
    again = refresh(spark, cfg, on_missing="keep")
    counts = {r.table_name: r.row_count for r in again.counts().collect()}
    assert counts["bronze_loan_accounts"] == 3 and counts["silver_rejected_records"] == 3
    assert counts["bronze_emi_payments"] == 0  # kept as the last release had it
    assert spark.table("lake_test.silver_customers").count() == 2
    assert rows(first.silver["customers"]) == old
    folders = lambda: {str(p).partition("release=")[2] for p in pathlib.Path(cfg.base_path).glob("*/**/release=*")}
    assert len(folders()) > 1
    assert Release(spark, cfg).expire(keep=1) and len(folders()) == 1
    assert spark.table("lake_test.silver_customers").count() == 2
    assert spark.table("lake_test.stg_portfolio_kpis").count() == 1


def test_published_views_read_one_partition(spark, lake_run):
    table = spark.table("lake_test.silver_loan_accounts")
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(release" in plan and "accepted" in plan.split("PartitionFilters")[1][:200]


def test_a_reader_sees_one_release_between_any_two_steps(spark, tmp_path, monkeypatch):
    cfg = LakeConfig(str(tmp_path), database="steps_test", as_of=AS_OF)
    spark.sql("CREATE DATABASE IF NOT EXISTS steps_test")
    for source in GOOD:
        write_csv(f"{tmp_path}/raw", source, record(source))
    first = refresh(spark, cfg, store=ReportingStore(path=f"{tmp_path}/store"))
    assert first.published.count() == 8 and first.published.filter("NOT matches").count() == 0
    watched = ("bronze_customers", "silver_customers", "gold_customer_loan_summary", "gold_portfolio_kpis", "stg_customer_loan_summary")

    def seen() -> tuple:
        return tuple(spark.sql(f"SELECT count(*) FROM steps_test.{n}").first()[0] for n in watched)

    old = seen()
    steps = []
    for name in ("save", "view", "publish", "_switch"):
        def step(self, *args, original=getattr(Release, name), name=name, **options):
            before = seen() if name in ("publish", "_switch") or len(steps) % 9 == 0 else old
            done = original(self, *args, **options)
            steps.append((name, before, seen() if name in ("publish", "_switch") else before))
            return done

        monkeypatch.setattr(Release, name, step)
    write_csv(f"{tmp_path}/raw", "customers", record("customers", customer_id="C7"), name="day2.csv")
    refresh(spark, cfg)
    new = seen()
    assert old == (1, 1, 1, 1, 1) and new == (2, 2, 2, 1, 2)
    assert all(before == old for _, before, _ in steps)
    assert {after for name, _, after in steps if name == "_switch"} == {new}
    assert {after for name, _, after in steps if name in ("save", "view")} == {old}
