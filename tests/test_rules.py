from __future__ import annotations

import pytest

from lendworks.operators.validate import ACCEPTED, accepted, reconcile, rejected, validate
from lendworks.sources.registry import SOURCES
from tests.helpers import bronze, parents, record, rows

# source, changed fields, codes expected; boundaries next to the violations they separate.
CASES = [
    ("branch_master", {}, []),
    ("branch_master", {"branch_id": "  "}, ["BRANCH_001"]),
    ("branch_master", {"branch_id": None}, ["BRANCH_001"]),
    ("branch_master", {"is_active": "n"}, []),
    ("branch_master", {"is_active": "X"}, ["BRANCH_003"]),
    ("branch_master", {"is_active": None}, ["BRANCH_003"]),
    ("customers", {}, []),
    ("customers", {"customer_id": ""}, ["CUST_001"]),
    ("customers", {"customer_id": None}, ["CUST_001"]),
    ("customers", {"customer_name": "   "}, ["CUST_003"]),
    ("customers", {"customer_name": None, "credit_score": None}, ["CUST_003", "CUST_004"]),
    ("customers", {"credit_score": 299}, ["CUST_004"]),
    ("customers", {"credit_score": 300}, []),
    ("customers", {"credit_score": 900}, []),
    ("customers", {"credit_score": 901}, ["CUST_004"]),
    ("customers", {"annual_income": 1}, []),
    ("customers", {"annual_income": 0}, ["CUST_005"]),
    ("customers", {"annual_income": None}, ["CUST_005"]),
    ("customers", {"created_date": "2024-13-01"}, []),
    ("loan_applications", {}, []),
    ("loan_applications", {"application_id": " "}, ["APP_001"]),
    ("loan_applications", {"customer_id": "C9"}, ["APP_003"]),
    ("loan_applications", {"customer_id": None, "branch_id": None}, ["APP_003", "APP_004"]),
    ("loan_applications", {"branch_id": "BR9"}, ["APP_004"]),
    ("loan_applications", {"requested_amount": -5}, ["APP_005"]),
    ("loan_applications", {"requested_amount": None}, ["APP_005"]),
    ("loan_applications", {"application_status": " pending "}, []),
    ("loan_applications", {"application_status": "DRAFT"}, ["APP_006"]),
    ("loan_applications", {"application_status": None}, ["APP_006"]),
    ("loan_accounts", {}, []),
    ("loan_accounts", {"loan_id": None}, ["LOAN_001"]),
    ("loan_accounts", {"customer_id": "C9"}, ["LOAN_003"]),
    ("loan_accounts", {"branch_id": "BR9"}, ["LOAN_004"]),
    ("loan_accounts", {"loan_amount": 0}, ["LOAN_005"]),
    ("loan_accounts", {"loan_amount": None}, ["LOAN_005"]),
    ("loan_accounts", {"interest_rate": 0.0}, ["LOAN_006"]),
    ("loan_accounts", {"interest_rate": None}, ["LOAN_006"]),
    ("loan_accounts", {"interest_rate": float("nan")}, ["LOAN_006"]),
    ("loan_accounts", {"interest_rate": 0.01}, []),
    ("loan_accounts", {"loan_status": "UNKNOWN"}, ["LOAN_007"]),
    ("loan_accounts", {"loan_status": None}, ["LOAN_007"]),
    ("emi_payments", {}, []),
    ("emi_payments", {"payment_id": ""}, ["EMI_001"]),
    ("emi_payments", {"loan_id": "L9"}, ["EMI_003"]),
    ("emi_payments", {"emi_amount": 0}, ["EMI_004"]),
    ("emi_payments", {"paid_amount": 0}, []),
    ("emi_payments", {"paid_amount": -1}, ["EMI_005"]),
    ("emi_payments", {"paid_amount": None}, ["EMI_005"]),
    ("emi_payments", {"payment_status": "VOID"}, ["EMI_006"]),
    ("emi_payments", {"payment_status": None}, ["EMI_006"]),
    ("emi_payments", {"payment_status": "missed", "paid_amount": 0}, []),
    ("emi_payments", {"payment_status": "missed", "paid_amount": 10}, ["EMI_007"]),
    ("emi_payments", {"payment_status": "missed", "paid_amount": None}, ["EMI_005"]),
    ("delinquency", {}, []),
    ("delinquency", {"delinquency_id": None}, ["DLQ_001"]),
    ("delinquency", {"loan_id": "L9"}, ["DLQ_002"]),
    ("delinquency", {"days_past_due": -1, "overdue_amount": -2}, ["DLQ_003", "DLQ_004"]),
    ("delinquency", {"days_past_due": None}, ["DLQ_003"]),
    ("delinquency", {"overdue_amount": None}, ["DLQ_004"]),
    ("delinquency", {"npa_flag": "?"}, ["DLQ_005"]),
    ("delinquency", {"npa_flag": None, "days_past_due": 95}, ["DLQ_005"]),
    ("delinquency", {"npa_flag": "?", "days_past_due": 95}, ["DLQ_005", "DLQ_006"]),
    ("delinquency", {"days_past_due": 90}, ["DLQ_006"]),
    ("delinquency", {"days_past_due": 89}, []),
    ("delinquency", {"days_past_due": 90, "npa_flag": "y"}, []),
    ("delinquency", {"days_past_due": 10, "npa_flag": "Y"}, []),
]


@pytest.mark.parametrize("source", list(SOURCES))
def test_every_case_breaks_exactly_its_rules(spark, source):
    spec = SOURCES[source]
    cases = [(changes, codes) for s, changes, codes in CASES if s == source]
    with_key = [c for c in cases if spec.key not in c[0]]
    records = [record(source, **{spec.key: f"K{i}"} | c) for i, (c, _) in enumerate(with_key)]
    judged = validate(bronze(spark, source, *records), spec, parents(spark, source))
    got = {r[0]: (list(r[1]), r[2]) for r in judged.select(spec.key, "broken_rules", ACCEPTED).collect()}
    for i, (changes, codes) in enumerate(with_key):
        assert got[f"K{i}"] == (codes, not codes), (source, changes)
    for changes, codes in (c for c in cases if spec.key in c[0]):
        judged = validate(bronze(spark, source, record(source, **changes)), spec, parents(spark, source))
        row = judged.first()
        assert (list(row["broken_rules"]), row[ACCEPTED]) == (codes, not codes), (source, changes)


def test_cases_cover_all_34_rules_but_uniqueness():
    declared = {r.code for s in SOURCES.values() for r in s.rules}
    assert len(declared) == 34
    unique = {r.code for s in SOURCES.values() for r in s.rules if r.kind == "unique"}
    assert declared - unique == {c for _, _, codes in CASES for c in codes}


def test_duplicates_latest_ingestion_wins_and_invalid_winner_rejects_the_key(spark):
    from datetime import datetime

    spec = SOURCES["customers"]
    old = bronze(spark, "customers", record("customers"), at=datetime(2026, 1, 1))
    new = bronze(spark, "customers", record("customers", annual_income=0), at=datetime(2026, 2, 1))
    df = validate(old.unionByName(new), spec)
    assert rows(df.select("annual_income", "broken_rules", ACCEPTED)) == [
        (0, ["CUST_005"], False),
        (500000, ["CUST_002"], False),
    ]


def test_blank_and_null_keys_number_their_own_copies(spark):
    spec = SOURCES["customers"]
    records = [record("customers", customer_id=k) for k in (None, None, " ", "", "C1")]
    df = validate(bronze(spark, "customers", *records), spec)
    assert rows(df.select("customer_id", "broken_rules")) == [
        ("", ["CUST_001", "CUST_002"]),
        ("", ["CUST_001"]),
        ("C1", []),
        (None, ["CUST_001", "CUST_002"]),
        (None, ["CUST_001"]),
    ]


def test_null_domain_value_is_rejected_or_dropped_by_policy(spark):
    spec = SOURCES["loan_accounts"]
    rows_in = bronze(
        spark,
        "loan_accounts",
        record("loan_accounts", loan_status=None),
        record("loan_accounts", loan_id="L2"),
    )
    ups = parents(spark, "loan_accounts")
    strict = validate(rows_in, spec, ups)
    assert [r["rule_code"] for r in rejected(strict, spec).collect()] == ["LOAN_007"]
    assert reconcile(strict, spec).first()["balanced"]

    lenient = validate(rows_in, spec, ups, null_policy="drop")
    assert rejected(lenient, spec).count() == 0
    assert [r["loan_id"] for r in accepted(lenient).collect()] == ["L2"]
    assert not reconcile(lenient, spec).first()["balanced"]


def test_envelope_has_one_row_per_broken_rule(spark):
    import json

    spec = SOURCES["customers"]
    df = validate(
        bronze(spark, "customers", record("customers", customer_name="", credit_score=None)), spec
    )
    out = rejected(df, spec)
    assert out.columns == [
        "source_table",
        "record_id",
        "rule_code",
        "rejection_reason",
        "rejected_timestamp",
        "raw_record_json",
    ]
    first, second = sorted(out.collect(), key=lambda r: r["rule_code"])
    assert (first["rule_code"], first["rejection_reason"]) == (
        "CUST_003",
        "customer_name is null or blank",
    )
    assert second["rule_code"] == "CUST_004"
    payload = json.loads(first["raw_record_json"])
    assert payload["customer_id"] == "C1" and payload["pipeline_layer"] == "BRONZE"
    assert list(payload)[:2] == ["customer_id", "customer_name"]
    assert "credit_score" not in payload  # NULL fields are left out
    assert not any(k.startswith("_") or k in ("broken_rules", ACCEPTED) for k in payload)


def test_silver_rows_keep_declared_order_and_audit(spark):
    spec = SOURCES["emi_payments"]
    df = validate(bronze(spark, "emi_payments", record("emi_payments")), spec, parents(spark, spec.name))
    out = accepted(df)
    assert out.columns == [
        *spec.columns,
        "source_file_name",
        "ingestion_timestamp",
        "load_date",
        "pipeline_layer",
        "source_system",
        "silver_processed_timestamp",
    ]
    assert out.first()["pipeline_layer"] == "SILVER"


def test_standardised_values(spark):
    import datetime

    spec = SOURCES["customers"]
    row = validate(bronze(spark, "customers", record("customers", dob="1990-02-31")), spec).first()
    assert (row.customer_name, row.gender, row.city, row.state, row.employment_type) == (
        "Asha Rao",
        "F",
        "Navi Mumbai",
        "Goa",
        "SALARIED",
    )
    assert row.dob is None and row.created_date == datetime.date(2024, 1, 1)
