from __future__ import annotations

import os

import pytest

from lendworks.config import LakeConfig
from lendworks.operators.validate import accepted, rejected, validate
from lendworks.plans.gold import GoldLayer
from lendworks.plans.silver import SilverLayer
from lendworks.sources.raw_files import CORRUPT, malformed_lines, read_raw, stamp_bronze, timestamp_literal
from lendworks.sources.registry import SOURCES
from lendworks.streaming.incremental import (
    IncrementalSilver,
    append_new_files,
    current_records,
    raw_file_stream,
    validate_new_rows,
    validated_log,
)
from lendworks.streaming.incremental_gold import IncrementalGold
from tests.helpers import AS_OF, Memory, parents, record, rows
from tests.test_refresh import write_csv

SPEC = SOURCES["emi_payments"]


def load(spark, base):
    now = timestamp_literal(AS_OF)
    stream = raw_file_stream(spark, SPEC, f"{base}/raw/emi_payments", now, now.cast("date"))
    append_new_files(stream, f"{base}/bronze", f"{base}/cp/bronze")
    query = validate_new_rows(
        spark,
        SPEC,
        f"{base}/bronze",
        stream.schema,
        lambda: parents(spark, SPEC.name),
        f"{base}/log",
        f"{base}/cp/silver",
        as_at=now,
    )
    return query, current_records(validated_log(spark, f"{base}/log"), SPEC)


def test_incremental_load_ends_where_a_full_refresh_does(spark, tmp_path):
    base, now = str(tmp_path), timestamp_literal(AS_OF)
    day1 = [
        record(SPEC.name),
        record(SPEC.name, payment_id="P2", loan_id="L9"),
        record(SPEC.name, payment_id="P3"),
        record(SPEC.name, payment_id="P3"),
    ]
    # P1 is corrected, P3's newest version is invalid and takes the key with it, P4 is new.
    day2 = [
        record(SPEC.name, paid_amount=60, payment_status="PARTIAL"),
        record(SPEC.name, payment_id="P3", paid_amount=-1),
        record(SPEC.name, payment_id="P4"),
    ]
    write_csv(f"{base}/raw", SPEC.name, *day1, name="day1.csv")
    _, current = load(spark, base)
    assert rows(accepted(current).select("payment_id", "paid_amount")) == [("P1", 100), ("P3", 100)]

    # Nothing new: no batch runs and nothing is repeated.
    query, current = load(spark, base)
    assert sum(p.numInputRows for p in query.recentProgress) == 0
    assert spark.read.parquet(f"{base}/bronze").count() == 4

    write_csv(f"{base}/raw", SPEC.name, *day2, name="day2.csv")
    _, current = load(spark, base)
    assert spark.read.parquet(f"{base}/bronze").count() == 7
    assert rows(accepted(current).select("payment_id", "paid_amount")) == [("P1", 60), ("P4", 100)]

    bronze = stamp_bronze(read_raw(spark, SPEC, f"{base}/raw/emi_payments"), SPEC, now, now.cast("date"))
    full = validate(bronze, SPEC, parents(spark, SPEC.name), as_at=now)
    compared = [c for c in full.columns if c not in ("source_file_name", "load_date")]
    assert rows(current.select(*compared)) == rows(full.select(*compared))
    assert rows(rejected(current, SPEC).select("record_id", "rule_code")) == rows(
        rejected(full, SPEC).select("record_id", "rule_code")
    )

    spread = current_records(validated_log(spark, f"{base}/log"), SPEC, ["P3"])
    assert rows(spread.select(*compared)) == rows(full.select(*compared))


def test_a_replayed_batch_replaces_its_own_output(spark, tmp_path):
    base = str(tmp_path)
    write_csv(f"{base}/raw", SPEC.name, record(SPEC.name))
    load(spark, base)
    log = f"{base}/log"
    before = validated_log(spark, log).count()
    # The batch folder is written in overwrite mode, so a second run of batch 0 adds nothing.
    query = validate_new_rows(
        spark,
        SPEC,
        f"{base}/bronze",
        spark.read.parquet(f"{base}/bronze").schema,
        lambda: parents(spark, SPEC.name),
        log,
        f"{base}/cp/other",
        as_at=timestamp_literal(AS_OF),
    )
    assert query.lastProgress is not None
    assert validated_log(spark, log).count() == before == 1


def test_loads_with_late_and_withdrawn_parents_end_where_a_full_refresh_does(spark, tmp_path):
    cfg = LakeConfig(str(tmp_path), as_of=AS_OF, batch_id="b")
    silver = IncrementalSilver(spark, cfg, buckets=8)
    loads = [
        # Children come before their parents.
        {"emi_payments": [record("emi_payments"), record("emi_payments", payment_id="P2", loan_id="L2")]},
        {
            "branch_master": [record("branch_master")],
            "customers": [record("customers"), record("customers", customer_id="C2")],
            "loan_applications": [record("loan_applications")],
            "loan_accounts": [record("loan_accounts"), record("loan_accounts", loan_id="L2", customer_id="C2", loan_type="auto_loan")],
            "delinquency": [
                record("delinquency"),
                record("delinquency", delinquency_id="D2", loan_id="L7"),
                record("delinquency", delinquency_id="D3", days_past_due=95, overdue_amount=7, npa_flag="Y"),
                record("delinquency", delinquency_id="D4", loan_id="L2", days_past_due=40),
            ],
        },
        {
            # C1 is withdrawn by a newer, invalid record; L2 changes its type; P3 is new, P1 is corrected.
            "customers": [record("customers", annual_income=-5, created_date="2025-01-01")],
            "loan_accounts": [
                record("loan_accounts", loan_id="L2", customer_id="C2", loan_type="home_loan", loan_start_date="2025-01-01")
            ],
            "emi_payments": [record("emi_payments", paid_amount=60), record("emi_payments", payment_id="P3", loan_id="L2")],
        },
    ]
    seen = []
    gold = IncrementalGold(spark, cfg, silver, buckets=4)
    for n, feeds in enumerate(loads):
        for source, records in feeds.items():
            write_csv(f"{tmp_path}/raw", source, *records, name=f"day{n}.csv")
        current = silver.load()
        bronze = {
            s: stamp_bronze(read_raw(spark, SOURCES[s], cfg.raw(s)), SOURCES[s], cfg.now(), cfg.today(), "b")
            if s in current
            else stamp_bronze(
                spark.createDataFrame([], SOURCES[s].schema).selectExpr("*", "'' AS source_file_name"), SOURCES[s], cfg.now(), cfg.today(), "b"
            )
            for s in SOURCES
        }
        full = SilverLayer(bronze, Memory().table, as_at=cfg.now())
        for source, records in current.items():
            compared = [c for c in full.validated(source).columns if c != "source_file_name"]
            assert rows(records.select(*compared)) == rows(full.validated(source).select(*compared)), (n, source)
        seen.append(sorted(r.payment_id for r in accepted(current["emi_payments"]).collect()))

        # Every row of the ledger is accepted or rejected now, and the zone holds the rejects of a full refresh.
        balance = {r.source: r for r in silver.balance().collect()}
        for source, records in current.items():
            assert balance[source].balanced and balance[source].read_rows == records.count(), (n, source)
            assert balance[source].accepted_rows == records.filter("accepted").count(), (n, source)
        zone = ("source_table", "record_id", "rule_code", "rejection_reason", "rejected_timestamp")
        assert rows(silver.rejects().select(*zone)) == rows(full.all_rejects().select(*zone)), n

        gold.load()
        whole = GoldLayer(full, Memory().table, cfg.today())
        marts = whole.tables()
        for name, mart in gold.tables().items():
            assert rows(mart) == rows(marts[name]), (n, name)
    assert seen == [[], ["P1", "P2"], ["P2", "P3"]]
    superseded = {r.source: r.superseded_rows for r in silver.balance().collect()}
    assert superseded["emi_payments"] == 1 and superseded["customers"] == 1 and superseded["loan_accounts"] == 1

    versions = {s: silver._last(s) for s in SOURCES}
    totals = gold.payments.last(), gold.months.last(), gold.reports.last()
    silver.load()  # nothing new: no version is written
    gold.load()
    assert {s: silver._last(s) for s in SOURCES} == versions
    assert (gold.payments.last(), gold.months.last(), gold.reports.last()) == totals

    before = {s: rows(silver.records(s)) for s in SOURCES}
    zone = rows(silver.rejects())
    gold.expire(keep=1)
    assert {s: rows(silver.records(s)) for s in SOURCES} == before and rows(silver.rejects()) == zone
    with pytest.raises(ValueError, match="8 buckets"):
        IncrementalSilver(spark, cfg, buckets=16)


def files_below(folder: str) -> dict[str, float]:
    return {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names}


def test_a_small_load_leaves_other_buckets_alone(spark, tmp_path):
    """One load in a thousand buckets: only those of the keys that came, or whose parent changed, get files."""
    cfg = LakeConfig(str(tmp_path), as_of=AS_OF)
    silver = IncrementalSilver(spark, cfg, buckets=1000)
    write_csv(f"{tmp_path}/raw", "branch_master", *(record("branch_master", branch_id=f"B{i}") for i in range(200)))
    silver.load()
    table = silver.tables["branch_master"]
    first = table.layout()
    held = files_below(table.path)
    write_csv(f"{tmp_path}/raw", "branch_master", *(record("branch_master", branch_id=f"B{i}", city="x") for i in range(6)), name="day2.csv")
    silver.load()
    now = table.layout()
    came = spark.createDataFrame([(f"B{i}",) for i in range(6)], "branch_id string")
    assert {b for b in now if now[b] != first.get(b)} == table.buckets_of(came) and len(first) > 100
    assert {f: t for f, t in files_below(table.path).items() if f in held} == held
    assert silver.records("branch_master").count() == 206 and silver.records("branch_master").filter("accepted").count() == 200
    # The rewritten buckets of the first version are all that goes.
    dropped = table.expire(keep=1)
    assert {int(d.rpartition("=")[2]) for d in dropped} == table.buckets_of(came) & set(first)
    assert silver.records("branch_master").filter("accepted AND city = 'X'").count() == 6


def test_a_load_that_failed_is_run_again(spark, tmp_path, monkeypatch):
    cfg = LakeConfig(str(tmp_path), as_of=AS_OF)
    silver = IncrementalSilver(spark, cfg, buckets=4)
    bad = record("customers", customer_id="C2", credit_score=1)
    write_csv(f"{tmp_path}/raw", "customers", record("customers"), bad)
    silver.load()
    write_csv(f"{tmp_path}/raw", "customers", record("customers", credit_score=2, created_date="2025-01-01"), name="day2.csv")

    def lost(*_):
        raise RuntimeError("lost")

    # Rejects and ledger are written, the records are not: the version does not count.
    with monkeypatch.context() as m:
        m.setattr(silver.tables["customers"], "write", lost)
        with pytest.raises(RuntimeError):
            silver.load()
    assert rows(silver.rejects().select("record_id", "rule_code")) == [("C2", "CUST_004")]
    silver.load()
    assert rows(silver.rejects().select("record_id", "rule_code")) == [("C1", "CUST_002"), ("C1", "CUST_004"), ("C2", "CUST_004")]
    balance = silver.balance().filter("source = 'customers'").first()
    assert (balance.read_rows, balance.accepted_rows, balance.rejected_rows, balance.superseded_rows) == (3, 0, 3, 1)


def test_stream_and_batch_report_the_same_malformed_lines(spark, tmp_path):
    cfg = LakeConfig(str(tmp_path), as_of=AS_OF)
    write_csv(f"{tmp_path}/raw", "customers", record("customers", credit_score="high"), record("customers", customer_id="C2"))
    write_csv(f"{tmp_path}/raw", "customers", record("customers", customer_id="C3", annual_income="?"), name="day2.csv")
    silver = IncrementalSilver(spark, cfg, buckets=4)
    assert silver.malformed().count() == 0
    # All columns must be read for a line to count as malformed, so both sides look at written rows.
    raw = read_raw(spark, SOURCES["customers"], cfg.raw("customers"), keep_corrupt=True)
    raw.write.parquet(f"{tmp_path}/rows")
    batch = rows(malformed_lines(spark.read.parquet(f"{tmp_path}/rows"), SOURCES["customers"]))
    for _ in range(2):
        silver.load()
        assert rows(silver.malformed()) == batch
    assert sorted(r.record_id for r in silver.malformed().collect()) == ["C1", "C3"]
    assert CORRUPT not in silver.records("customers").columns
