"""Declared sources: schema, cleansing, keys, references and validation rules of each feed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from lendworks.operators.rules import (
    Rule,
    exists,
    implies,
    key_present,
    non_negative,
    one_of,
    positive,
    required,
    unique,
    within,
)

# Audit columns every Bronze row carries, in table order.
BRONZE_AUDIT = (
    "source_file_name",
    "ingestion_timestamp",
    "load_date",
    "pipeline_layer",
    "source_system",
)


PARENT_PREFIX = "parent_"


@dataclass(frozen=True)
class SourceSpec:
    name: str
    key: str
    ddl: str
    cleanse: dict[str, str]
    rules: tuple[Rule, ...]
    references: dict[str, str] = field(default_factory=dict)  # column -> parent source
    # Parent columns kept beside the child in its validated table, as reference column -> names. The
    # reference check visits the parent anyway, and Gold then needs no join of its own for them.
    carried: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # Business order among copies of one key after ingestion time and file, as (column, direction).
    latest_by: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def bronze_table(self) -> str:
        return f"bronze_{self.name}"

    @property
    def system(self) -> str:
        return self.name.upper()

    @property
    def deduplicated(self) -> bool:
        return any(r.kind == "unique" for r in self.rules)


# Column names, rule codes, rejection reasons and value domains are a public contract.
BRANCH_MASTER = SourceSpec(
    name="branch_master",
    key="branch_id",
    ddl="""branch_id string, branch_name string, city string, state string, region string,
           opened_date string, is_active string""",
    cleanse={
        "branch_id": "trim",
        "branch_name": "trim",
        "city": "title",
        "state": "title",
        "region": "title",
        "opened_date": "date",
        "is_active": "upper",
    },
    rules=(
        key_present("BRANCH_001", "branch_id is null or blank", "branch_id"),
        unique("BRANCH_002", "duplicate branch_id", "branch_id"),
        one_of("BRANCH_003", "is_active must be Y or N", "is_active", ("Y", "N")),
    ),
)

CUSTOMERS = SourceSpec(
    name="customers",
    key="customer_id",
    ddl="""customer_id string, customer_name string, gender string, dob string, city string,
           state string, employment_type string, annual_income int, credit_score int,
           created_date string""",
    cleanse={
        "customer_id": "trim",
        "customer_name": "trim",
        "gender": "upper",
        "dob": "date",
        "city": "title",
        "state": "title",
        "employment_type": "upper",
        "created_date": "date",
    },
    rules=(
        key_present("CUST_001", "customer_id is null or blank", "customer_id"),
        unique("CUST_002", "duplicate customer_id", "customer_id"),
        required("CUST_003", "customer_name is null or blank", "customer_name"),
        within("CUST_004", "credit_score must be between 300 and 900", "credit_score", 300, 900),
        positive("CUST_005", "annual_income must be greater than 0", "annual_income"),
    ),
    latest_by=(("created_date", "desc"), ("customer_name", "asc")),
)

LOAN_APPLICATIONS = SourceSpec(
    name="loan_applications",
    key="application_id",
    ddl="""application_id string, customer_id string, branch_id string, loan_type string,
           requested_amount int, application_date string, application_status string,
           credit_score_at_application int, decision_reason string""",
    cleanse={
        "application_id": "trim",
        "customer_id": "trim",
        "branch_id": "trim",
        "loan_type": "upper",
        "application_date": "date",
        "application_status": "upper",
    },
    rules=(
        key_present("APP_001", "application_id is null or blank", "application_id"),
        unique("APP_002", "duplicate application_id", "application_id"),
        exists("APP_003", "customer_id does not exist in silver_customers", "customer_id"),
        exists("APP_004", "branch_id does not exist in silver_branch_master", "branch_id"),
        positive("APP_005", "requested_amount must be greater than 0", "requested_amount"),
        one_of(
            "APP_006",
            "invalid application_status",
            "application_status",
            ("APPROVED", "REJECTED", "PENDING"),
        ),
    ),
    references={"customer_id": "customers", "branch_id": "branch_master"},
    latest_by=(("application_date", "desc"),),
)

LOAN_ACCOUNTS = SourceSpec(
    name="loan_accounts",
    key="loan_id",
    ddl="""loan_id string, application_id string, customer_id string, branch_id string,
           loan_type string, loan_amount int, interest_rate double, tenure_months int,
           loan_start_date string, loan_status string""",
    cleanse={
        "loan_id": "trim",
        "application_id": "trim",
        "customer_id": "trim",
        "branch_id": "trim",
        "loan_type": "upper",
        "loan_start_date": "date",
        "loan_status": "upper",
    },
    rules=(
        key_present("LOAN_001", "loan_id is null or blank", "loan_id"),
        unique("LOAN_002", "duplicate loan_id", "loan_id"),
        exists("LOAN_003", "customer_id does not exist in silver_customers", "customer_id"),
        exists("LOAN_004", "branch_id does not exist in silver_branch_master", "branch_id"),
        positive("LOAN_005", "loan_amount must be greater than 0", "loan_amount"),
        positive("LOAN_006", "interest_rate must be greater than 0", "interest_rate"),
        one_of("LOAN_007", "invalid loan_status", "loan_status", ("ACTIVE", "CLOSED", "DEFAULTED")),
    ),
    references={"customer_id": "customers", "branch_id": "branch_master"},
    latest_by=(("loan_start_date", "desc"),),
)

EMI_PAYMENTS = SourceSpec(
    name="emi_payments",
    key="payment_id",
    ddl="""payment_id string, loan_id string, emi_due_date string, emi_paid_date string,
           emi_amount int, paid_amount int, payment_status string, payment_mode string""",
    cleanse={
        "payment_id": "trim",
        "loan_id": "trim",
        "emi_due_date": "date",
        "emi_paid_date": "date",
        "payment_status": "upper",
        "payment_mode": "upper",
    },
    rules=(
        key_present("EMI_001", "payment_id is null or blank", "payment_id"),
        unique("EMI_002", "duplicate payment_id", "payment_id"),
        exists("EMI_003", "loan_id does not exist in silver_loan_accounts", "loan_id"),
        positive("EMI_004", "emi_amount must be greater than 0", "emi_amount"),
        non_negative("EMI_005", "paid_amount must be greater than or equal to 0", "paid_amount"),
        one_of(
            "EMI_006",
            "invalid payment_status",
            "payment_status",
            ("PAID", "LATE", "PARTIAL", "MISSED"),
        ),
        implies(
            "EMI_007",
            "MISSED payments should have paid_amount = 0",
            when="payment_status = 'MISSED'",
            then="paid_amount = 0",
        ),
    ),
    references={"loan_id": "loan_accounts"},
    carried={"loan_id": ("loan_type",)},
    latest_by=(
        ("emi_due_date", "desc"),
        ("emi_amount", "desc"),
        ("paid_amount", "desc"),
        ("payment_status", "asc"),
        ("loan_id", "asc"),
        ("emi_paid_date", "asc"),
    ),
)

DELINQUENCY = SourceSpec(
    name="delinquency",
    key="delinquency_id",
    ddl="""delinquency_id string, loan_id string, days_past_due int, overdue_amount int,
           npa_flag string, report_date string""",
    cleanse={
        "delinquency_id": "trim",
        "loan_id": "trim",
        "npa_flag": "upper",
        "report_date": "date",
    },
    rules=(
        key_present("DLQ_001", "delinquency_id is null or blank", "delinquency_id"),
        exists("DLQ_002", "loan_id does not exist in silver_loan_accounts", "loan_id"),
        non_negative("DLQ_003", "days_past_due must be greater than or equal to 0", "days_past_due"),
        non_negative(
            "DLQ_004", "overdue_amount must be greater than or equal to 0", "overdue_amount"
        ),
        one_of("DLQ_005", "npa_flag must be Y or N", "npa_flag", ("Y", "N")),
        implies(
            "DLQ_006",
            "npa_flag must be Y when days_past_due >= 90",
            when="days_past_due >= 90",
            then="npa_flag = 'Y'",
        ),
    ),
    references={"loan_id": "loan_accounts"},
)

# Parents come before their children.
SOURCES: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        BRANCH_MASTER,
        CUSTOMERS,
        LOAN_APPLICATIONS,
        LOAN_ACCOUNTS,
        EMI_PAYMENTS,
        DELINQUENCY,
    )
}
