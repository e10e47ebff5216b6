"""Reference SQL for the registered queries, written for DuckDB.

Each statement states the result directly (one predicate per rule, plain joins, distinct counts) and
shares nothing with the Spark implementation but the text of the six loan views.
"""

from __future__ import annotations

import re

from lendworks.sources.loan_views import VIEW_SQL


def _title(column: str) -> str:
    words = f"string_split(lower(trim({column})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _round(value: str, digits: int = 2) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    ratio = f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"
    return f"CASE WHEN {whole} > 0 THEN {_round(f'({ratio})')} ELSE CAST(0 AS DOUBLE) END"


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _status(column: str, value: str, prefix: str = "") -> str:
    return _big(f"sum(CASE WHEN {prefix}{column} = '{value}' THEN 1 ELSE 0 END)")


CTES: dict[str, str] = {f"fx_{name}": sql for name, sql in VIEW_SQL.items()}

# Standardised feeds --------------------------------------------------------------------------------

CTES["std_branch_master"] = f"""
SELECT trim(branch_id) AS branch_id, trim(branch_name) AS branch_name, {_title('city')} AS city,
       {_title('state')} AS state, {_title('region')} AS region,
       TRY_CAST(opened_date AS DATE) AS opened_date, upper(trim(is_active)) AS is_active
FROM fx_branch_master"""
CTES["std_customers"] = f"""
SELECT trim(customer_id) AS customer_id, trim(customer_name) AS customer_name,
       upper(trim(gender)) AS gender, TRY_CAST(dob AS DATE) AS dob, {_title('city')} AS city,
       {_title('state')} AS state, upper(trim(employment_type)) AS employment_type, annual_income,
       credit_score, TRY_CAST(created_date AS DATE) AS created_date
FROM fx_customers"""
CTES["std_loan_applications"] = """
SELECT trim(application_id) AS application_id, trim(customer_id) AS customer_id,
       trim(branch_id) AS branch_id, upper(trim(loan_type)) AS loan_type, requested_amount,
       TRY_CAST(application_date AS DATE) AS application_date,
       upper(trim(application_status)) AS application_status, credit_score_at_application,
       decision_reason
FROM fx_loan_applications"""
CTES["std_loan_accounts"] = """
SELECT trim(loan_id) AS loan_id, trim(application_id) AS application_id,
       trim(customer_id) AS customer_id, trim(branch_id) AS branch_id,
       upper(trim(loan_type)) AS loan_type, loan_amount, interest_rate, tenure_months,
       TRY_CAST(loan_start_date AS DATE) AS loan_start_date, upper(trim(loan_status)) AS loan_status
FROM fx_loan_accounts"""
CTES["std_emi_payments"] = """
SELECT trim(payment_id) AS payment_id, trim(loan_id) AS loan_id,
       TRY_CAST(emi_due_date AS DATE) AS emi_due_date, TRY_CAST(emi_paid_date AS DATE) AS emi_paid_date,
       emi_amount, paid_amount, upper(trim(payment_status)) AS payment_status,
       upper(trim(payment_mode)) AS payment_mode
FROM fx_emi_payments"""
CTES["std_delinquency"] = """
SELECT trim(delinquency_id) AS delinquency_id, trim(loan_id) AS loan_id, days_past_due,
       overdue_amount, upper(trim(npa_flag)) AS npa_flag, TRY_CAST(report_date AS DATE) AS report_date
FROM fx_delinquency"""

# Declared columns

_COLUMNS = {
    "branch_master": "branch_id branch_name city state region opened_date is_active",
    "customers": "customer_id customer_name gender dob city state employment_type annual_income "
    "credit_score created_date",
    "loan_applications": "application_id customer_id branch_id loan_type requested_amount "
    "application_date application_status credit_score_at_application decision_reason",
    "loan_accounts": "loan_id application_id customer_id branch_id loan_type loan_amount "
    "interest_rate tenure_months loan_start_date loan_status",
    "emi_payments": "payment_id loan_id emi_due_date emi_paid_date emi_amount paid_amount "
    "payment_status payment_mode",
    "delinquency": "delinquency_id loan_id days_past_due overdue_amount npa_flag report_date",
}


def _as_text(source: str, empty: bool = False) -> str:
    """All declared fields of a record in one text; NULL shows as a question mark, rates as hundredths."""
    fields = (
        f"CAST(round({c} * 100) AS BIGINT)" if c == "interest_rate" else c for c in _COLUMNS[source].split()
    )
    texts = (f"CAST({f} AS VARCHAR)" for f in fields)
    return " || '|' || ".join(f"coalesce({f"nullif({t}, '')" if empty else t}, '?')" for t in texts)


# Copies of a key, newest first ---------------------------------------------------------------------

_NEWEST = {
    "branch_master": (
        "branch_id",
        "branch_name NULLS FIRST, city NULLS FIRST, state NULLS FIRST, region NULLS FIRST, "
        "opened_date NULLS FIRST, is_active NULLS FIRST",
    ),
    "customers": (
        "customer_id",
        "created_date DESC NULLS LAST, customer_name NULLS FIRST, gender NULLS FIRST, "
        "dob NULLS FIRST, city NULLS FIRST, state NULLS FIRST, employment_type NULLS FIRST, "
        "annual_income NULLS FIRST, credit_score NULLS FIRST",
    ),
    "loan_applications": ("application_id", "application_date DESC NULLS LAST"),
    "loan_accounts": ("loan_id", "loan_start_date DESC NULLS LAST"),
    "emi_payments": (
        "payment_id",
        "emi_due_date DESC NULLS LAST, emi_amount DESC NULLS LAST, paid_amount DESC NULLS LAST, "
        "payment_status NULLS FIRST, loan_id NULLS FIRST, emi_paid_date NULLS FIRST, "
        "payment_mode NULLS FIRST",
    ),
}
for _source, (_key, _order) in _NEWEST.items():
    # Ties are settled by all other columns, so that the survivor is certain.
    _named = {part.split()[0] for part in _order.split(",")} | {_key}
    _order += "".join(f", {c} NULLS FIRST" for c in _COLUMNS[_source].split() if c not in _named)
    CTES[f"rank_{_source}"] = (
        f"SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY {_order}) AS rn "
        f"FROM std_{_source}"
    )
CTES["rank_delinquency"] = "SELECT *, 1 AS rn FROM std_delinquency"

# Rules: code -> (source, reason, rejection predicate over rank_*) ------------------------------

_IDS = {
    "branch_master": "branch_id",
    "customers": "customer_id",
    "loan_applications": "application_id",
    "loan_accounts": "loan_id",
    "emi_payments": "payment_id",
    "delinquency": "delinquency_id",
}


def _blank(column: str) -> str:
    return f"({column} IS NULL OR {column} = '')"


def _not_in(column: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"coalesce({column} NOT IN ({listed}), true)"


def _orphan(column: str, parent: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM ok_{parent} p WHERE p.{column} = t.{column})"


RULES: dict[str, tuple[str, str, str]] = {
    "BRANCH_001": ("branch_master", "branch_id is null or blank", _blank("branch_id")),
    "BRANCH_002": ("branch_master", "duplicate branch_id", "rn > 1"),
    "BRANCH_003": ("branch_master", "is_active must be Y or N", _not_in("is_active", "Y", "N")),
    "CUST_001": ("customers", "customer_id is null or blank", _blank("customer_id")),
    "CUST_002": ("customers", "duplicate customer_id", "rn > 1"),
    "CUST_003": ("customers", "customer_name is null or blank", _blank("customer_name")),
    "CUST_004": (
        "customers",
        "credit_score must be between 300 and 900",
        "(credit_score < 300 OR credit_score > 900 OR credit_score IS NULL)",
    ),
    "CUST_005": (
        "customers",
        "annual_income must be greater than 0",
        "(annual_income <= 0 OR annual_income IS NULL)",
    ),
    "APP_001": ("loan_applications", "application_id is null or blank", _blank("application_id")),
    "APP_002": ("loan_applications", "duplicate application_id", "rn > 1"),
    "APP_003": (
        "loan_applications",
        "customer_id does not exist in silver_customers",
        _orphan("customer_id", "customers"),
    ),
    "APP_004": (
        "loan_applications",
        "branch_id does not exist in silver_branch_master",
        _orphan("branch_id", "branch_master"),
    ),
    "APP_005": (
        "loan_applications",
        "requested_amount must be greater than 0",
        "(requested_amount <= 0 OR requested_amount IS NULL)",
    ),
    "APP_006": (
        "loan_applications",
        "invalid application_status",
        _not_in("application_status", "APPROVED", "REJECTED", "PENDING"),
    ),
    "LOAN_001": ("loan_accounts", "loan_id is null or blank", _blank("loan_id")),
    "LOAN_002": ("loan_accounts", "duplicate loan_id", "rn > 1"),
    "LOAN_003": (
        "loan_accounts",
        "customer_id does not exist in silver_customers",
        _orphan("customer_id", "customers"),
    ),
    "LOAN_004": (
        "loan_accounts",
        "branch_id does not exist in silver_branch_master",
        _orphan("branch_id", "branch_master"),
    ),
    "LOAN_005": (
        "loan_accounts",
        "loan_amount must be greater than 0",
        "(loan_amount <= 0 OR loan_amount IS NULL)",
    ),
    "LOAN_006": (
        "loan_accounts",
        "interest_rate must be greater than 0",
        "(interest_rate <= 0 OR interest_rate IS NULL)",
    ),
    "LOAN_007": (
        "loan_accounts",
        "invalid loan_status",
        _not_in("loan_status", "ACTIVE", "CLOSED", "DEFAULTED"),
    ),
    "EMI_001": ("emi_payments", "payment_id is null or blank", _blank("payment_id")),
    "EMI_002": ("emi_payments", "duplicate payment_id", "rn > 1"),
    "EMI_003": (
        "emi_payments",
        "loan_id does not exist in silver_loan_accounts",
        _orphan("loan_id", "loan_accounts"),
    ),
    "EMI_004": (
        "emi_payments",
        "emi_amount must be greater than 0",
        "(emi_amount <= 0 OR emi_amount IS NULL)",
    ),
    "EMI_005": (
        "emi_payments",
        "paid_amount must be greater than or equal to 0",
        "(paid_amount < 0 OR paid_amount IS NULL)",
    ),
    "EMI_006": (
        "emi_payments",
        "invalid payment_status",
        _not_in("payment_status", "PAID", "LATE", "PARTIAL", "MISSED"),
    ),
    "EMI_007": (
        "emi_payments",
        "MISSED payments should have paid_amount = 0",
        "coalesce(payment_status = 'MISSED' AND paid_amount <> 0, false)",
    ),
    "DLQ_001": ("delinquency", "delinquency_id is null or blank", _blank("delinquency_id")),
    "DLQ_002": (
        "delinquency",
        "loan_id does not exist in silver_loan_accounts",
        _orphan("loan_id", "loan_accounts"),
    ),
    "DLQ_003": (
        "delinquency",
        "days_past_due must be greater than or equal to 0",
        "(days_past_due < 0 OR days_past_due IS NULL)",
    ),
    "DLQ_004": (
        "delinquency",
        "overdue_amount must be greater than or equal to 0",
        "(overdue_amount < 0 OR overdue_amount IS NULL)",
    ),
    "DLQ_005": ("delinquency", "npa_flag must be Y or N", _not_in("npa_flag", "Y", "N")),
    "DLQ_006": (
        "delinquency",
        "npa_flag must be Y when days_past_due >= 90",
        "coalesce(days_past_due >= 90 AND npa_flag <> 'Y', false)",
    ),
}

for _source in _IDS:
    _predicates = [p for s, _, p in RULES.values() if s == _source]
    CTES[f"ok_{_source}"] = (
        f"SELECT * EXCLUDE (rn) FROM rank_{_source} t WHERE NOT ("
        + " OR ".join(f"({p})" for p in _predicates)
        + ")"
    )
    CTES[f"bad_{_source}"] = " UNION ALL ".join(
        f"SELECT 'bronze_{s}' AS source_table, {_IDS[s]} AS record_id, '{code}' AS rule_code, "
        f"'{reason}' AS rejection_reason FROM rank_{s} t WHERE {predicate}"
        for code, (s, reason, predicate) in RULES.items()
        if s == _source
    )
CTES["bad_all"] = " UNION ALL ".join(f"SELECT * FROM bad_{s}" for s in _IDS)


def _hits(*codes: str) -> str:
    """Records breaking the given rules."""
    return " UNION ALL ".join(
        f"SELECT 'bronze_{RULES[c][0]}' AS source_table, {_IDS[RULES[c][0]]} AS record_id, "
        f"'{c}' AS rule_code FROM rank_{RULES[c][0]} t WHERE {RULES[c][2]}"
        for c in codes
    )


# Gold ----------------------------------------------------------------------------------------------

_LOAN_COUNTS = f"""
       {_status('loan_status', 'ACTIVE')} AS active_loan_count,
       {_status('loan_status', 'CLOSED')} AS closed_loan_count,
       {_status('loan_status', 'DEFAULTED')} AS defaulted_loan_count"""
_PAYMENT_COUNTS = f"""
       {_status('payment_status', 'PAID', 'p.')} AS paid_count,
       {_status('payment_status', 'LATE', 'p.')} AS late_count,
       {_status('payment_status', 'PARTIAL', 'p.')} AS partial_count,
       {_status('payment_status', 'MISSED', 'p.')} AS missed_count"""
_PAYMENT_SUMS = """
       count(DISTINCT p.payment_id) AS total_emi_records,
       CAST(sum(p.emi_amount) AS BIGINT) AS total_emi_due,
       CAST(sum(p.paid_amount) AS BIGINT) AS total_amount_paid"""

CTES["g_customer_loans"] = f"""
SELECT customer_id, count(DISTINCT loan_id) AS total_loans,
       CAST(sum(loan_amount) AS BIGINT) AS total_loan_amount,
       {_round('avg(interest_rate)', 10)} AS avg_interest_rate, {_LOAN_COUNTS}
FROM ok_loan_accounts GROUP BY customer_id"""
CTES["g_customer_payments"] = f"""
SELECT l.customer_id, {_PAYMENT_SUMS},
       {_status('payment_status', 'PAID', 'p.')} AS paid_emi_count,
       {_status('payment_status', 'LATE', 'p.')} AS late_emi_count,
       {_status('payment_status', 'MISSED', 'p.')} AS missed_emi_count,
       {_status('payment_status', 'PARTIAL', 'p.')} AS partial_emi_count
FROM ok_emi_payments p JOIN ok_loan_accounts l ON p.loan_id = l.loan_id GROUP BY l.customer_id"""
CTES["g_customer_delinquency"] = """
SELECT l.customer_id, max(d.days_past_due) AS max_days_past_due,
       CAST(sum(d.overdue_amount) AS BIGINT) AS total_overdue_amount,
       CAST(max(CASE WHEN d.npa_flag = 'Y' THEN 1 ELSE 0 END) AS INT) AS has_npa_flag
FROM ok_delinquency d JOIN ok_loan_accounts l ON d.loan_id = l.loan_id GROUP BY l.customer_id"""
CTES["g_branch_loans"] = f"""
SELECT branch_id, count(DISTINCT loan_id) AS total_loans,
       count(DISTINCT customer_id) AS total_borrowers,
       CAST(sum(loan_amount) AS BIGINT) AS total_disbursed_amount,
       {_round('avg(interest_rate)', 10)} AS avg_interest_rate,
       {_status('loan_status', 'ACTIVE')} AS active_loans,
       {_status('loan_status', 'CLOSED')} AS closed_loans,
       {_status('loan_status', 'DEFAULTED')} AS defaulted_loans
FROM ok_loan_accounts GROUP BY branch_id"""
CTES["g_branch_payments"] = f"""
SELECT l.branch_id, CAST(sum(p.emi_amount) AS BIGINT) AS total_emi_due,
       CAST(sum(p.paid_amount) AS BIGINT) AS total_collected_amount,
       {_status('payment_status', 'MISSED', 'p.')} AS missed_emi_count,
       {_status('payment_status', 'LATE', 'p.')} AS late_emi_count
FROM ok_emi_payments p JOIN ok_loan_accounts l ON p.loan_id = l.loan_id GROUP BY l.branch_id"""
CTES["g_branch_delinquency"] = f"""
SELECT l.branch_id, CAST(sum(d.overdue_amount) AS BIGINT) AS total_overdue_amount,
       max(d.days_past_due) AS max_days_past_due,
       {_status('npa_flag', 'Y', 'd.')} AS npa_records
FROM ok_delinquency d JOIN ok_loan_accounts l ON d.loan_id = l.loan_id GROUP BY l.branch_id"""
CTES["g_loan_payments"] = f"""
SELECT p.loan_id, {_PAYMENT_SUMS}, {_PAYMENT_COUNTS}
FROM ok_emi_payments p GROUP BY p.loan_id"""
CTES["g_loan_delinquency"] = """
SELECT loan_id, max(days_past_due) AS max_days_past_due,
       CAST(sum(overdue_amount) AS BIGINT) AS total_overdue_amount,
       CAST(max(CASE WHEN npa_flag = 'Y' THEN 1 ELSE 0 END) AS INT) AS has_npa_flag
FROM ok_delinquency GROUP BY loan_id"""


def _filled(alias: str, *columns: str) -> str:
    return ", ".join(f"coalesce({alias}.{c}, 0) AS {c}" for c in columns)


CTES["customer_measures"] = f"""
SELECT c.*, {_filled('la', 'total_loans', 'total_loan_amount', 'avg_interest_rate',
                     'active_loan_count', 'closed_loan_count', 'defaulted_loan_count')},
       {_filled('pa', 'total_emi_records', 'total_emi_due', 'total_amount_paid', 'paid_emi_count',
                'late_emi_count', 'missed_emi_count', 'partial_emi_count')},
       {_filled('da', 'max_days_past_due', 'total_overdue_amount', 'has_npa_flag')}
FROM (SELECT customer_id, customer_name, gender, city, state, employment_type, annual_income,
             credit_score FROM ok_customers) c
LEFT JOIN g_customer_loans la ON c.customer_id = la.customer_id
LEFT JOIN g_customer_payments pa ON c.customer_id = pa.customer_id
LEFT JOIN g_customer_delinquency da ON c.customer_id = da.customer_id"""
_CUSTOMER_RISK = """CASE WHEN has_npa_flag = 1 OR max_days_past_due >= 90 THEN 'HIGH'
            WHEN missed_emi_count > 0 OR max_days_past_due >= 30 THEN 'MEDIUM' ELSE 'LOW' END"""
CTES["gold_customer"] = f"""
SELECT *, {_pct('total_amount_paid', 'total_emi_due')} AS collection_rate,
       {_CUSTOMER_RISK} AS risk_category
FROM customer_measures"""
CTES["branch_measures"] = f"""
SELECT b.*, {_filled('la', 'total_loans', 'total_borrowers', 'total_disbursed_amount',
                     'avg_interest_rate', 'active_loans', 'closed_loans', 'defaulted_loans')},
       {_filled('pa', 'total_emi_due', 'total_collected_amount', 'missed_emi_count',
                'late_emi_count')},
       {_filled('da', 'total_overdue_amount', 'max_days_past_due', 'npa_records')}
FROM (SELECT branch_id, branch_name, city, state, region, is_active FROM ok_branch_master) b
LEFT JOIN g_branch_loans la ON b.branch_id = la.branch_id
LEFT JOIN g_branch_payments pa ON b.branch_id = pa.branch_id
LEFT JOIN g_branch_delinquency da ON b.branch_id = da.branch_id"""
CTES["gold_branch"] = f"""
SELECT *, {_pct('total_collected_amount', 'total_emi_due')} AS collection_rate,
       {_pct('defaulted_loans', 'total_loans')} AS default_rate
FROM branch_measures"""
CTES["monthly_measures"] = f"""
SELECT strftime(p.emi_due_date, '%Y-%m') AS emi_due_month, l.loan_type, {_PAYMENT_SUMS},
       count(DISTINCT p.loan_id) AS total_loans, {_PAYMENT_COUNTS}
FROM ok_emi_payments p JOIN ok_loan_accounts l ON p.loan_id = l.loan_id GROUP BY 1, 2"""
CTES["gold_monthly"] = f"""
SELECT *, {_pct('total_amount_paid', 'total_emi_due')} AS collection_rate,
       {_pct('missed_count', 'total_emi_records')} AS missed_rate
FROM monthly_measures"""
CTES["loan_measures"] = f"""
SELECT l.loan_id, l.application_id, l.customer_id, c.customer_name, c.credit_score,
       c.annual_income, l.branch_id, b.branch_name, b.city, b.state, b.region, l.loan_type,
       l.loan_amount, l.interest_rate, l.loan_start_date, l.loan_status,
       {_filled('p', 'total_emi_records', 'total_emi_due', 'total_amount_paid', 'paid_count',
                'late_count', 'partial_count', 'missed_count')},
       {_filled('d', 'max_days_past_due', 'total_overdue_amount', 'has_npa_flag')}
FROM ok_loan_accounts l
LEFT JOIN ok_customers c ON l.customer_id = c.customer_id
LEFT JOIN ok_branch_master b ON l.branch_id = b.branch_id
LEFT JOIN g_loan_payments p ON l.loan_id = p.loan_id
LEFT JOIN g_loan_delinquency d ON l.loan_id = d.loan_id"""
CTES["loan_scores"] = f"""
SELECT *, {_pct('total_amount_paid', 'total_emi_due')} AS collection_rate,
       CASE WHEN has_npa_flag = 1 OR max_days_past_due >= 90 THEN 100
            WHEN missed_count >= 2 OR max_days_past_due >= 60 THEN 80
            WHEN missed_count = 1 OR late_count >= 2 OR max_days_past_due >= 30 THEN 60
            WHEN late_count = 1 OR partial_count >= 1 THEN 40 ELSE 20 END AS risk_score
FROM loan_measures"""


def _loan_band(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 90 THEN 'CRITICAL' WHEN {score} >= 70 THEN 'HIGH' "
        f"WHEN {score} >= 50 THEN 'MEDIUM' ELSE 'LOW' END"
    )


CTES["gold_loan"] = f"SELECT *, {_loan_band('risk_score')} AS risk_category FROM loan_scores"
CTES["kpi_measures"] = f"""
SELECT count(DISTINCT loan_id) AS total_loans, count(DISTINCT customer_id) AS total_customers,
       {_big('sum(loan_amount)')} AS total_loan_portfolio, {_big('sum(total_emi_due)')} AS total_emi_due,
       {_big('sum(total_amount_paid)')} AS total_amount_collected,
       {_big('sum(total_overdue_amount)')} AS total_overdue_amount,
       {_status('loan_status', 'ACTIVE')} AS active_loans,
       {_status('loan_status', 'CLOSED')} AS closed_loans,
       {_status('loan_status', 'DEFAULTED')} AS defaulted_loans,
       {_big("sum(CASE WHEN risk_category IN ('HIGH', 'CRITICAL') THEN 1 ELSE 0 END)")} AS high_risk_loans,
       {_round('avg(risk_score)')} AS avg_risk_score
FROM gold_loan"""
CTES["gold_kpis"] = f"""
SELECT *, {_pct('total_amount_collected', 'total_emi_due')} AS collection_rate,
       {_pct('defaulted_loans', 'total_loans')} AS default_rate,
       {_pct('high_risk_loans', 'total_loans')} AS high_risk_loan_rate, DATE '2026-06-30' AS kpi_date
FROM kpi_measures"""

_BRANCH_HEALTH = """CASE WHEN default_rate >= 10 OR collection_rate < 75 THEN 'HIGH_RISK_BRANCH'
            WHEN default_rate >= 5 OR collection_rate < 90 THEN 'WATCHLIST_BRANCH'
            ELSE 'HEALTHY_BRANCH' END"""
CTES["branch_risk_measures"] = f"""
SELECT branch_id, branch_name, city, state, region, count(*) AS total_loans,
       {_big('sum(loan_amount)')} AS total_disbursed_amount,
       {_big('sum(total_overdue_amount)')} AS total_overdue_amount,
       {_big('sum(has_npa_flag)')} AS npa_loans, max(max_days_past_due) AS max_days_past_due,
       {_big('sum(total_emi_due)')} AS due, {_big('sum(total_amount_paid)')} AS paid,
       {_status('loan_status', 'DEFAULTED')} AS defaulted
FROM gold_loan GROUP BY branch_id, branch_name, city, state, region"""
CTES["branch_risk_rates"] = f"""
SELECT * EXCLUDE (due, paid, defaulted),
       {_pct('total_overdue_amount', 'total_disbursed_amount')} AS overdue_rate,
       {_pct('npa_loans', 'total_loans')} AS npa_rate, {_pct('paid', 'due')} AS collection_rate,
       {_pct('defaulted', 'total_loans')} AS default_rate
FROM branch_risk_measures"""
CTES["npa_measures"] = f"""
SELECT region, loan_type, count(*) AS total_loans, {_big('sum(has_npa_flag)')} AS npa_loans,
       {_big('sum(CASE WHEN has_npa_flag = 1 THEN loan_amount ELSE 0 END)')} AS npa_amount,
       {_big('sum(total_overdue_amount)')} AS total_overdue_amount
FROM gold_loan GROUP BY region, loan_type"""

# Reporting marts -----------------------------------------------------------------------------------

CTES["mart_high_risk"] = """
SELECT loan_id, customer_id, customer_name, branch_id, branch_name, region, loan_type, loan_amount,
       collection_rate, missed_count, max_days_past_due, total_overdue_amount, risk_score,
       risk_category, true AS requires_collection_attention
FROM gold_loan WHERE risk_category IN ('CRITICAL', 'HIGH')"""
CTES["mart_branch"] = f"""
SELECT branch_id, branch_name, city, state, region, total_loans, total_borrowers,
       total_disbursed_amount, collection_rate, default_rate, total_overdue_amount, npa_records,
       {_BRANCH_HEALTH} AS branch_health_status
FROM gold_branch"""
CTES["mart_trend"] = """
SELECT emi_due_month, loan_type, total_emi_records, total_loans, total_emi_due, total_amount_paid,
       collection_rate, missed_rate, paid_count, late_count, partial_count, missed_count,
       CASE WHEN collection_rate >= 95 THEN 'EXCELLENT' WHEN collection_rate >= 85 THEN 'GOOD'
            WHEN collection_rate >= 70 THEN 'NEEDS_ATTENTION' ELSE 'POOR'
            END AS collection_performance_band
FROM gold_monthly"""
CTES["mart_executive"] = """
SELECT kpi_date, total_loans, total_customers, total_loan_portfolio, total_emi_due,
       total_amount_collected, total_overdue_amount, active_loans, closed_loans, defaulted_loans,
       high_risk_loans, avg_risk_score, collection_rate, default_rate, high_risk_loan_rate,
       CASE WHEN high_risk_loan_rate >= 15 OR default_rate >= 10 THEN 'HIGH_PORTFOLIO_RISK'
            WHEN high_risk_loan_rate >= 8 OR default_rate >= 5 THEN 'MEDIUM_PORTFOLIO_RISK'
            ELSE 'LOW_PORTFOLIO_RISK' END AS portfolio_health_status
FROM gold_kpis"""

# Expectations: (suite, model, test, column, failure count) ------------------------------------------


def _test(suite: str, model: str, test: str, column: str, failures: str) -> str:
    return (
        f"SELECT '{suite}' AS suite, '{model}' AS model, '{test}' AS test, "
        f"'{column}' AS column_name, CAST(({failures}) AS BIGINT) AS failures"
    )


def _nulls(suite: str, model: str, table: str, column: str) -> str:
    return _test(
        suite, model, "not_null", column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    )


def _dups(suite: str, model: str, table: str, column: str) -> str:
    repeated = (
        f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1"
    )
    return _test(suite, model, "unique", column, f"SELECT count(*) FROM ({repeated})")


def _values(suite: str, model: str, table: str, column: str, *allowed: str) -> str:
    listed = ", ".join(f"'{v}'" for v in allowed)
    return _test(
        suite,
        model,
        "accepted_values",
        column,
        f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({listed})",
    )


def _suite() -> list[str]:
    tests = []
    for suite, prefix in (("source", "gold_"), ("staging", "stg_")):
        for model, table, key in (
            ("customer_loan_summary", "gold_customer", "customer_id"),
            ("branch_performance_summary", "gold_branch", "branch_id"),
            ("loan_default_risk_summary", "gold_loan", "loan_id"),
        ):
            tests.append(_nulls(suite, prefix + model, table, key))
            tests.append(_dups(suite, prefix + model, table, key))
        tests.append(_nulls(suite, prefix + "loan_default_risk_summary", "gold_loan", "customer_id"))
        for column in ("emi_due_month", "loan_type"):
            model = prefix + "monthly_collection_summary"
            tests.append(_nulls(suite, model, "gold_monthly", column))
    stg = "stg_loan_default_risk_summary"
    levels = ("LOW", "MEDIUM", "HIGH")
    tests += [
        _values("staging", "stg_customer_loan_summary", "gold_customer", "risk_category", *levels),
        _values("staging", "stg_branch_performance_summary", "gold_branch", "is_active", "Y", "N"),
        _values("staging", stg, "gold_loan", "risk_category", *levels, "CRITICAL"),
        _test(
            "staging",
            stg,
            "relationships",
            "customer_id",
            "SELECT count(*) FROM gold_loan l WHERE customer_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM gold_customer c WHERE c.customer_id = l.customer_id)",
        ),
        _nulls("mart", "mart_high_risk_loans", "mart_high_risk", "loan_id"),
        _dups("mart", "mart_high_risk_loans", "mart_high_risk", "loan_id"),
        _values("mart", "mart_high_risk_loans", "mart_high_risk", "risk_category", "HIGH", "CRITICAL"),
        _nulls("mart", "mart_branch_risk_dashboard", "mart_branch", "branch_id"),
        _dups("mart", "mart_branch_risk_dashboard", "mart_branch", "branch_id"),
        _values(
            "mart",
            "mart_branch_risk_dashboard",
            "mart_branch",
            "branch_health_status",
            "HEALTHY_BRANCH",
            "WATCHLIST_BRANCH",
            "HIGH_RISK_BRANCH",
        ),
        _nulls("mart", "mart_collection_trend", "mart_trend", "emi_due_month"),
        _values(
            "mart",
            "mart_collection_trend",
            "mart_trend",
            "collection_performance_band",
            "EXCELLENT",
            "GOOD",
            "NEEDS_ATTENTION",
            "POOR",
        ),
        _nulls("mart", "mart_portfolio_executive_summary", "mart_executive", "kpi_date"),
        _values(
            "mart",
            "mart_portfolio_executive_summary",
            "mart_executive",
            "portfolio_health_status",
            "LOW_PORTFOLIO_RISK",
            "MEDIUM_PORTFOLIO_RISK",
            "HIGH_PORTFOLIO_RISK",
        ),
        _test(
            "singular",
            stg,
            "non_negative",
            "loan_amount",
            "SELECT count(*) FROM gold_loan WHERE loan_amount < 0",
        ),
        _test(
            "singular",
            stg,
            "rate_range",
            "collection_rate",
            "SELECT count(*) FROM gold_loan WHERE collection_rate < 0 OR collection_rate > 100",
        ),
        _test(
            "singular",
            "stg_portfolio_kpis",
            "row_count",
            "",
            "SELECT CASE WHEN count(*) <> 1 THEN 1 ELSE 0 END FROM gold_kpis",
        ),
    ]
    return tests


_GOLD = {
    "customer_loan_summary": "gold_customer",
    "branch_performance_summary": "gold_branch",
    "monthly_collection_summary": "gold_monthly",
    "loan_default_risk_summary": "gold_loan",
    "portfolio_kpis": "gold_kpis",
}

# Columns of the staging views by name; rates and averages, which are doubles, to ten decimals.
_GOLD_COLUMNS = {
    "customer_loan_summary": """active_loan_count annual_income *avg_interest_rate city closed_loan_count *collection_rate
        credit_score customer_id customer_name defaulted_loan_count employment_type gender has_npa_flag late_emi_count
        max_days_past_due missed_emi_count paid_emi_count partial_emi_count risk_category state total_amount_paid
        total_emi_due total_emi_records total_loan_amount total_loans total_overdue_amount""",
    "branch_performance_summary": """active_loans *avg_interest_rate branch_id branch_name city closed_loans *collection_rate
        *default_rate defaulted_loans is_active late_emi_count max_days_past_due missed_emi_count npa_records region state
        total_borrowers total_collected_amount total_disbursed_amount total_emi_due total_loans total_overdue_amount""",
    "monthly_collection_summary": """*collection_rate emi_due_month late_count loan_type missed_count *missed_rate paid_count
        partial_count total_amount_paid total_emi_due total_emi_records total_loans""",
    "loan_default_risk_summary": """annual_income application_id branch_id branch_name city *collection_rate credit_score
        customer_id customer_name has_npa_flag *interest_rate late_count loan_amount loan_id loan_start_date loan_status
        loan_type max_days_past_due missed_count paid_count partial_count region risk_category risk_score state
        total_amount_paid total_emi_due total_emi_records total_overdue_amount""",
    "portfolio_kpis": """active_loans *avg_risk_score closed_loans *collection_rate *default_rate defaulted_loans
        *high_risk_loan_rate high_risk_loans kpi_date total_amount_collected total_customers total_emi_due
        total_loan_portfolio total_loans total_overdue_amount""",
}


def _texts(columns: str) -> str:
    values = (f"CAST(round({c[1:]} * 10000000000) AS BIGINT)" if c[0] == "*" else c for c in columns.split())
    return ", ".join(f"coalesce(CAST({v} AS VARCHAR), '?')" for v in values)



def _counts(tables: dict[str, str], name: str = "table_name") -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS {name}, count(*) AS row_count FROM {cte}" for t, cte in tables.items()
    )


def _reconciled(source: str) -> str:
    broken = " + ".join(
        f"CASE WHEN {p} THEN 1 ELSE 0 END" for s, _, p in RULES.values() if s == source
    )
    return f"""
SELECT '{source}' AS source, count(*) AS bronze_rows, count(*) FILTER (n = 0) AS accepted_rows,
       count(*) FILTER (n > 0) AS rejected_rows, {_big('sum(n)')} AS reject_records, true AS balanced
FROM (SELECT {broken} AS n FROM rank_{source} t)"""


def _cascade(code: str, column: str, parent: str) -> str:
    source, _, predicate = RULES[code]
    return f"""
SELECT 'bronze_{source}' AS source_table, {_IDS[source]} AS record_id, '{code}' AS rule_code
FROM rank_{source} t WHERE {predicate}
  AND EXISTS (SELECT 1 FROM std_{parent} p WHERE p.{column} = t.{column})"""


def _queries() -> dict[str, str]:
    q = {
        "std_branch": "SELECT * FROM std_branch_master",
        "std_customers": "SELECT * FROM std_customers",
        "std_applications": "SELECT * FROM std_loan_applications",
        "std_loans": "SELECT * FROM std_loan_accounts",
        "std_payments": "SELECT * FROM std_emi_payments",
        "std_delinquency": "SELECT * FROM std_delinquency",
    }
    present = {"BRANCH_001", "CUST_001", "APP_001", "LOAN_001", "EMI_001", "DLQ_001"}
    q["rule_key_present"] = " UNION ALL ".join(
        f"SELECT '{c}' AS rule_code, count(*) AS checked_rows, count(*) FILTER ({p}) AS broken_rows "
        f"FROM std_{s}"
        for c, (s, _, p) in RULES.items()
        if c in present
    )
    q["rule_required_text"] = _hits("CUST_003")
    q["rule_range"] = _hits("CUST_004")
    q["rule_positive"] = _hits("CUST_005", "APP_005", "LOAN_005", "LOAN_006", "EMI_004")
    q["rule_non_negative"] = _hits("EMI_005", "DLQ_003", "DLQ_004")
    q["rule_domain"] = _hits("BRANCH_003", "APP_006", "LOAN_007", "EMI_006", "DLQ_005")
    q["rule_implication"] = _hits("EMI_007", "DLQ_006")
    q["dedupe_latest"] = " UNION ALL ".join(
        f"SELECT '{s}' AS feed, {_as_text(s)} AS record FROM rank_{s} WHERE rn = 1" for s in _NEWEST
    )
    q["rule_unique"] = _hits("BRANCH_002", "CUST_002", "APP_002", "LOAN_002", "EMI_002")
    q["rule_reference"] = _hits("APP_003", "APP_004", "LOAN_003", "LOAN_004", "EMI_003", "DLQ_002")
    q["orphans_anti_join"] = (
        f"SELECT * FROM std_emi_payments t WHERE {_orphan('loan_id', 'loan_accounts')}"
    )
    q["cascade_rejects"] = " UNION ALL ".join(
        _cascade(*c)
        for c in (
            ("APP_003", "customer_id", "customers"),
            ("APP_004", "branch_id", "branch_master"),
            ("LOAN_003", "customer_id", "customers"),
            ("LOAN_004", "branch_id", "branch_master"),
            ("EMI_003", "loan_id", "loan_accounts"),
            ("DLQ_002", "loan_id", "loan_accounts"),
        )
    )
    for source in _IDS:
        q[f"silver_{source}"] = f"SELECT *, 'SILVER' AS pipeline_layer FROM ok_{source}"
    q["rejects_envelope"] = " UNION ALL ".join(
        f"SELECT 'bronze_{s}' AS source_table, {_IDS[s]} AS record_id, '{code}' AS rule_code, "
        f"'{reason}' AS rejection_reason, true AS at_run_time, {_as_text(s)} AS payload "
        f"FROM rank_{s} t WHERE {predicate}"
        for code, (s, reason, predicate) in RULES.items()
    )
    q["rejects_all"] = "SELECT * FROM bad_all"
    q["rejected_zone"] = "SELECT * FROM bad_all"
    q["rejects_by_rule"] = """
SELECT source_table, rule_code, rejection_reason, count(*) AS rejected_count
FROM bad_all GROUP BY 1, 2, 3"""
    q["layer_reconcile"] = " UNION ALL ".join(_reconciled(s) for s in _IDS)

    owned = {
        "g_customer_loans": "total_loans, total_loan_amount, avg_interest_rate, active_loan_count, closed_loan_count, "
        "defaulted_loan_count",
        "g_customer_payments": "total_emi_records, total_emi_due, total_amount_paid, paid_emi_count, late_emi_count, "
        "missed_emi_count, partial_emi_count",
        "g_customer_delinquency": "max_days_past_due, total_overdue_amount, has_npa_flag",
        "g_branch_loans": "total_loans, total_borrowers, total_disbursed_amount, avg_interest_rate, active_loans, "
        "closed_loans, defaulted_loans",
        "g_branch_payments": "total_emi_due, total_collected_amount, missed_emi_count, late_emi_count",
        "g_branch_delinquency": "total_overdue_amount, max_days_past_due, npa_records",
    }
    for name, measures in owned.items():
        owner = name.split("_")[1]
        q[name] = f"SELECT {owner}_id, {measures} FROM {owner}_measures WHERE total_loans > 0"
    for name in ("g_loan_payments", "g_loan_delinquency"):
        q[name] = f"SELECT * FROM {name}"
    q["safe_pct"] = "SELECT loan_id, collection_rate FROM gold_loan"
    q["status_counts"] = f"""
SELECT payment_mode, {_PAYMENT_COUNTS} FROM ok_emi_payments p GROUP BY payment_mode"""
    q["zero_fill"] = """
SELECT customer_id, customer_name, total_loans, total_loan_amount, active_loan_count,
       closed_loan_count, defaulted_loan_count FROM customer_measures"""
    q["customer_risk_category"] = (
        "SELECT customer_id, risk_category FROM gold_customer WHERE total_loans > 0"
    )
    q["loan_risk_score"] = "SELECT loan_id, risk_score FROM gold_loan"
    q["loan_risk_category"] = "SELECT loan_id, risk_category FROM gold_loan"
    for name, cte in _GOLD.items():
        q[f"gold_{name}"] = f"SELECT * FROM {cte}"
    q["gold_branch_risk_summary"] = (
        f"SELECT *, {_BRANCH_HEALTH} AS branch_health_status FROM branch_risk_rates"
    )
    q["gold_npa_summary"] = f"SELECT *, {_pct('npa_loans', 'total_loans')} AS npa_rate FROM npa_measures"
    weighted = (
        "CAST(sum(CAST(risk_score AS BIGINT) * loan_amount) AS DOUBLE)"
        " / CAST(sum(loan_amount) AS DOUBLE)"
    )
    q["gold_customer_risk_score"] = f"""
SELECT customer_id, max(risk_score) AS max_risk_score,
       {_round(f'({weighted})')} AS exposure_weighted_score,
       {_big('sum(loan_amount)')} AS total_loan_amount,
       {_loan_band('max(risk_score)')} AS risk_category
FROM gold_loan GROUP BY customer_id"""

    q["top_customers"] = """
SELECT customer_id, customer_name, total_loans, total_loan_amount, collection_rate,
       max_days_past_due, total_overdue_amount, risk_category
FROM gold_customer ORDER BY total_loan_amount DESC, customer_id LIMIT 10"""
    q["branch_ranking"] = """
SELECT branch_id, branch_name, city, region, total_loans, total_disbursed_amount, collection_rate,
       default_rate, total_overdue_amount
FROM gold_branch ORDER BY total_disbursed_amount DESC, branch_id"""
    q["monthly_trend"] = "SELECT * FROM gold_monthly ORDER BY emi_due_month, loan_type"
    q["top_risky_loans"] = """
SELECT loan_id, customer_id, customer_name, loan_type, loan_amount, collection_rate, missed_count,
       max_days_past_due, total_overdue_amount, risk_score, risk_category
FROM gold_loan ORDER BY risk_score DESC, total_overdue_amount DESC, loan_id LIMIT 20"""
    q["stg_views"] = " UNION ALL ".join(
        f"SELECT 'stg_{n}' AS view_name, concat_ws('|', {_texts(columns)}) AS record FROM {_GOLD[n]}" for n, columns in _GOLD_COLUMNS.items()
    )
    q["mart_high_risk_loans"] = "SELECT * FROM mart_high_risk"
    q["mart_branch_risk_dashboard"] = "SELECT * FROM mart_branch"
    q["mart_collection_trend"] = "SELECT * FROM mart_trend"
    q["mart_portfolio_executive_summary"] = "SELECT * FROM mart_executive"

    q["expect_not_null"] = " UNION ALL ".join(
        _nulls("feed", s, f"std_{s}", c) for s, cs in _COLUMNS.items() for c in cs.split()
    )
    q["expect_unique"] = " UNION ALL ".join(
        f"SELECT '{s}' AS feed, {key} AS record_id, count(*) AS cnt FROM std_{s} "
        f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"
        for s, key in _IDS.items()
    )
    domains = {
        "branch_master": ("is_active", "'Y', 'N'"),
        "loan_applications": ("application_status", "'APPROVED', 'REJECTED', 'PENDING'"),
        "loan_accounts": ("loan_status", "'ACTIVE', 'CLOSED', 'DEFAULTED'"),
        "emi_payments": ("payment_status", "'PAID', 'LATE', 'PARTIAL', 'MISSED'"),
        "delinquency": ("npa_flag", "'Y', 'N'"),
    }
    q["expect_accepted_values"] = " UNION ALL ".join(
        f"SELECT '{s}' AS feed, {_IDS[s]} AS record_id, {c} AS value FROM std_{s} WHERE {c} NOT IN ({values})"
        for s, (c, values) in domains.items()
    )
    references = (
        ("loan_applications", "customer_id", "customers"),
        ("loan_applications", "branch_id", "branch_master"),
        ("loan_accounts", "customer_id", "customers"),
        ("loan_accounts", "branch_id", "branch_master"),
        ("emi_payments", "loan_id", "loan_accounts"),
        ("delinquency", "loan_id", "loan_accounts"),
    )
    q["expect_relationships"] = " UNION ALL ".join(
        f"SELECT '{s}' AS feed, '{c}' AS column_name, t.{c} AS value, count(*) AS cnt FROM std_{s} t "
        f"WHERE t.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM std_{p} p WHERE p.{_IDS[p]} = t.{c}) GROUP BY t.{c}"
        for s, c, p in references
    )
    amounts = (
        ("customers", "annual_income"),
        ("loan_applications", "requested_amount"),
        ("loan_accounts", "loan_amount"),
        ("emi_payments", "emi_amount"),
        ("emi_payments", "paid_amount"),
        ("delinquency", "overdue_amount"),
    )
    q["expect_amounts"] = " UNION ALL ".join(
        f"SELECT '{s}' AS feed, {_IDS[s]} AS record_id, '{c}' AS column_name FROM std_{s} WHERE {c} < 0"
        for s, c in amounts
    )
    q["expect_rate_range"] = f"""
SELECT * FROM (
  SELECT loan_id, {_pct('paid', 'due')} AS collection_rate
  FROM (SELECT loan_id, {_big('sum(emi_amount)')} AS due, {_big('sum(paid_amount)')} AS paid
        FROM std_emi_payments GROUP BY loan_id))
WHERE collection_rate < 0 OR collection_rate > 100"""
    q["expect_one_row"] = (
        f"SELECT model, CAST(row_count <> 1 AS BIGINT) AS failures FROM ({_counts(_GOLD, 'model')})"
    )
    q["expect_suite"] = " UNION ALL ".join(_suite())

    feeds = {s: f"fx_{s}" for s in _IDS}
    q["bronze_ingest_roundtrip"] = " UNION ALL ".join(
        # An empty field of a CSV file is read as NULL.
        f"SELECT '{s}' AS feed, {_as_text(s, empty=True)} AS record, '{s.upper()}' AS source_system FROM {cte}"
        for s, cte in feeds.items()
    )
    numbers = {
        "int": "annual_income credit_score requested_amount credit_score_at_application loan_amount tenure_months emi_amount "
        "paid_amount days_past_due overdue_amount",
        "double": "interest_rate",
    }
    kinds = {c: kind for kind, columns in numbers.items() for c in columns.split()}
    q["source_schemas"] = " UNION ALL ".join(
        f"SELECT '{s}' AS feed, '{c}' AS column_name, '{kinds.get(c, 'string')}' AS type, "
        f"count(nullif(CAST({c} AS VARCHAR), '')) AS filled FROM {feeds[s]}"
        for s, columns in _COLUMNS.items()
        for c in columns.split()
    )
    q["gold_audit"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) AS audited_count FROM {cte}" for t, cte in _GOLD.items()
    )
    q["bronze_audit"] = " UNION ALL ".join(
        f"SELECT 'BRONZE' AS pipeline_layer, '{s.upper()}' AS source_system, "
        f"'2026-06-30' AS batch_id, count(*) AS record_count, count(*) AS audited_count FROM {cte}"
        for s, cte in feeds.items()
    )
    q["audit_rollup"] = " UNION ALL ".join(
        f"SELECT 'BRONZE' AS pipeline_layer, '{s.upper()}' AS source_system, "
        f"count(*) AS record_count FROM {cte}"
        for s, cte in feeds.items()
    )
    q["row_counts"] = _counts(
        {f"bronze_{s}": cte for s, cte in feeds.items()}
        | {f"silver_{s}": f"ok_{s}" for s in _IDS}
        | {"silver_rejected_records": "bad_all"}
        | {f"gold_{n}": cte for n, cte in _GOLD.items()}
    )
    # Of the listed files one feed's have another name than expected, one is empty and one did not come.
    q["source_arrival"] = " UNION ALL ".join(
        f"SELECT '{s}' AS source, {str(s not in ('delinquency', 'customers')).lower()} AS has_files, count(*) AS rows, "
        f"{str(s in ('delinquency', 'customers')).lower()} AS is_missing FROM {cte}"
        + " WHERE false" * (s in ("delinquency", "branch_master"))
        for s, cte in feeds.items()
    )
    q["file_arrival"] = " UNION ALL ".join(
        f"SELECT '{s}' AS source, CASE WHEN count(*) > 0 THEN '{status}' ELSE 'empty' END AS status, "
        f"{str(there).lower()} AS has_files, {str(there).lower()} AS has_bytes FROM {feeds[s]}"
        for s, status, there in (
            ("branch_master", "empty", True),
            ("customers", "unexpected", True),
            ("customers", "missing", False),
            ("loan_applications", "arrived", True),
            ("loan_accounts", "arrived", True),
            ("emi_payments", "arrived", True),
            ("delinquency", "missing", False),
        )
    )
    expected = {
        "branch_master": ("supplier", 0.0),
        "customers": ("customer", 0.02),
        "loan_applications": ("orders", 0.0),
        "loan_accounts": ("orders", 0.05),
        "emi_payments": ("lineitem", 0.05),
        "delinquency": ("events", 0.05),
    }
    q["volume_check"] = " UNION ALL ".join(
        f"SELECT '{s}' AS source, (SELECT count(*) FROM {base}) AS expected_rows, count(*) AS actual_rows, "
        f"abs(count(*) - (SELECT count(*) FROM {base})) <= CAST((SELECT count(*) FROM {base}) * {tol} AS DOUBLE) "
        f"AS within_expectation FROM {feeds[s]}"
        for s, (base, tol) in expected.items()
    )
    q["publish_reconcile"] = " UNION ALL ".join(
        f"SELECT 'gold_{n}' AS source_table, 'GOLD_{n.upper()}' AS target_table, "
        f"count(*) AS source_rows, count(*) AS target_rows, true AS matches FROM {cte}"
        for n, cte in _GOLD.items()
    )
    q["stream_ingest_count"] = _counts(feeds)
    return q


def _with_ctes(sql: str) -> str:
    """Prefix a statement with the CTEs it needs, in definition order."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        for word in set(re.findall(r"\w+", todo.pop())):
            if word in CTES and word not in needed:
                needed.add(word)
                todo.append(CTES[word])
    if not needed:
        return sql
    listed = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items() if name in needed)
    return f"WITH {listed}\n{sql}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_ctes(sql) for name, sql in _queries().items()}
