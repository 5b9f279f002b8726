"""Raw-table operators and audits in plain SQL."""

from __future__ import annotations

from adjudica.schema import (
    ANNUAL_AMOUNTS,
    CONDITIONS,
    FACTS,
    MAX_LENGTHS,
    NOT_NULL,
    PRIMARY_KEYS,
    RAW_COLUMNS,
    REQUIRED_COLUMNS,
    STAR_SCHEMAS,
)
from oracles.star_sql import CTES, amount, day, flag, renal, stay, text, with_star


def _shown(table: str) -> str:
    """Columns of a star table in portable types."""
    casts = {"date": "VARCHAR", "int": "BIGINT", "decimal(12,2)": "DOUBLE"}
    parts = []
    for field in STAR_SCHEMAS[table].fields:
        kind = casts.get(field.dataType.simpleString())
        parts.append(f"CAST({field.name} AS {kind}) AS {field.name}" if kind else field.name)
    return ", ".join(parts)


def _missing(column: str) -> str:
    return f"{text(column)} AS {column}"


_OUT_COLUMNS = ", ".join(
    f"CAST({f.name} AS VARCHAR) AS {f.name}" if f.dataType.simpleString() == "date"
    else f"CAST({f.name} AS DOUBLE) AS {f.name}" if f.dataType.simpleString().startswith("decimal") else f.name
    for f in STAR_SCHEMAS["fact_outpatient_claims"].fields
)
_DATE = "CAST({} AS VARCHAR) AS {}"


def _dates(key: str, pairs: list[tuple[str | None, str]], table: str) -> str:
    parts = [
        f"CAST({day(source)} AS VARCHAR) AS {name}" if source else f"CAST(NULL AS VARCHAR) AS {name}"
        for source, name in pairs
    ]
    return f"SELECT {key} AS ClaimID, {', '.join(parts)} FROM {table}"


_NAMES = ["ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt"]
_TABLES = list(STAR_SCHEMAS)

_RULES = [
    ("label_domain", "error", "labels", "count(*) FILTER (trim(PotentialFraud) NOT IN ('Yes', 'No', '0', '1'))"),
    ("duplicate_providers", "error", "labels", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT Provider FROM raw_labels) d)"),
    ("birth_in_future", "error", "beneficiary", f"count(*) FILTER ({day('DOB')} > DATE '2024-01-01')"),
    ("death_before_birth", "error", "beneficiary", f"count(*) FILTER ({day('DOD')} < {day('DOB')})"),
    ("negative_reimbursement", "error", "inpatient", "count(*) FILTER (TRY_CAST(InscClaimAmtReimbursed AS DECIMAL(18,2)) < 0)"),
    ("discharge_before_admission", "warning", "inpatient", f"count(*) FILTER ({day('DischargeDt')} < {day('AdmissionDt')})"),
    ("duplicate_claims", "warning", "inpatient", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT ClaimID FROM raw_inpatient) d)"),
    ("negative_reimbursement", "error", "outpatient", "count(*) FILTER (TRY_CAST(InscClaimAmtReimbursed AS DECIMAL(18,2)) < 0)"),
]


def _broken(columns: str, test: str) -> str:
    """Rows in which one of the columns has a text that fails the test."""
    tests = [f"({text(c)}) IS NOT NULL AND {test.format(c)}" for c in columns.split()]
    return f"count(*) FILTER ({' OR '.join(f'({t})' for t in tests)})"


_CLAIM_DAYS, _CLAIM_MONEY = "ClaimStartDt ClaimEndDt", "InscClaimAmtReimbursed DeductibleAmtPaid"
_YEARLY = "IPAnnualReimbursementAmt IPAnnualDeductibleAmt OPAnnualReimbursementAmt OPAnnualDeductibleAmt"
for _table, _ids, _days, _money_columns in (
    ("labels", "Provider", "", ""),
    ("beneficiary", "BeneID", "DOB DOD", _YEARLY),
    ("inpatient", "ClaimID BeneID Provider", f"{_CLAIM_DAYS} AdmissionDt DischargeDt", _CLAIM_MONEY),
    ("outpatient", "ClaimID BeneID Provider", _CLAIM_DAYS, _CLAIM_MONEY),
):
    _none = " OR ".join(f"({text(c)}) IS NULL" for c in _ids.split())
    _RULES.append(("missing_id", "error", _table, f"count(*) FILTER ({_none})"))
    if _days:
        _bad_day = " OR ".join(f"(({text(c)}) IS NOT NULL AND {day(c)} IS NULL)" for c in _days.split())
        _RULES.append(("unreadable_date", "warning", _table, f"count(*) FILTER ({_bad_day})"))
        _RULES.append(("unreadable_amount", "error", _table, _broken(_money_columns, "TRY_CAST(trim({0}) AS DOUBLE) IS NULL")))
        _RULES.append(("amount_too_large", "error", _table, _broken(_money_columns, "abs(TRY_CAST(trim({0}) AS DOUBLE)) >= 9999999999.995")))
_RULES.append(("conflicting_labels", "error", "labels", """(SELECT count(*) - count(DISTINCT p) FROM (
  SELECT DISTINCT trim(Provider) AS p, trim(PotentialFraud) FROM raw_labels WHERE Provider IS NOT NULL AND PotentialFraud IS NOT NULL) d) + 0 * count(*)"""))
_AUDIT_ROWS = " UNION ALL ".join(
    [
        f"SELECT '{rule}' AS rule, 'error' AS severity, '{table}' AS \"table\", CAST(0 AS BIGINT) AS violations"
        for table in REQUIRED_COLUMNS
        for rule in ("required_table", "required_columns", "leakage_columns")
    ]
    + [
        f"SELECT '{rule}', '{severity}', '{table}', CAST({count} AS BIGINT) FROM raw_{table}"
        for rule, severity, table, count in _RULES
    ]
)
_AUDIT = f"SELECT *, CASE WHEN violations = 0 THEN 'passed' ELSE 'failed' END AS status FROM ({_AUDIT_ROWS}) r"

_CHECKS = {
    "dim_providers": [("fraud_label", "check_domain", "fraud_label NOT IN ('Yes', 'No')")],
    "dim_beneficiaries": [("gender", "check_domain", "gender NOT IN (1, 2)")],
}
for _fact in FACTS:
    _CHECKS[_fact] = [(c, "check_not_negative", f"{c} < 0") for c in ("reimbursed_amount", "deductible_amount")]
_CHECKS["fact_inpatient_claims"].append(("length_of_stay", "check_not_negative", "length_of_stay < 0"))
_CHECKS["fact_claims_unified"].append(("claim_type", "check_domain", "claim_type NOT IN ('Inpatient', 'Outpatient')"))


def _constraints() -> str:
    parts = []
    for table in _TABLES:
        rules = [(c, "not_null", f"{c} IS NULL") for c in NOT_NULL[table]] + _CHECKS[table]
        rules += [(c, "max_length", f"length({c}) > {n}") for c, n in MAX_LENGTHS[table].items()]
        parts += [
            f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", '{rule}' AS rule, count(*) FILTER ({test}) AS violations FROM {table}"
            for c, rule, test in rules
        ]
    return " UNION ALL ".join(parts)


def _foreign_keys(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{shown}' AS \"table\", '{key}' AS \"column\", count(*) AS violations FROM {table} f"
        f" ANTI JOIN {dim} d ON f.{key} = d.{key} WHERE f.{key} IS NOT NULL"
        for shown, table in tables.items()
        for key, dim in (("provider_id", "dim_providers"), ("bene_id", "dim_beneficiaries"))
    )


def _counts(tables: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in tables)


def _sample(n: int) -> str:
    places = (
        f"greatest(1, (SELECT {n} * count(*) FILTER (trim(PotentialFraud) = 'Yes') // count(PotentialFraud) FROM raw_labels))"
    )
    return f"""SELECT Provider, PotentialFraud FROM (SELECT *, row_number() OVER (PARTITION BY trim(PotentialFraud)
  ORDER BY md5('42|' || Provider), Provider) AS r, count(*) OVER () AS n FROM raw_labels) t
  WHERE n <= {n} OR r <= CASE trim(PotentialFraud) WHEN 'Yes' THEN {places} WHEN 'No' THEN {n} - {places} END"""


_BODIES = {
    **{
        f"s01_read_raw_{table}": f"SELECT {', '.join(_missing(c) for c in columns)} FROM raw_{table}"
        for table, columns in RAW_COLUMNS.items()
    },
    "e01_build_providers": f"SELECT {_shown('dim_providers')} FROM dim_providers",
    "e02_build_beneficiaries": f"SELECT {_shown('dim_beneficiaries')} FROM dim_beneficiaries",
    "e03_decode_flag": f"SELECT BeneID, {', '.join(f'{flag(raw)} AS {name}' for raw, name in CONDITIONS.items())} FROM raw_beneficiary",
    "e04_decode_renal": f"SELECT BeneID, {renal('RenalDiseaseIndicator')} AS renal_disease FROM raw_beneficiary",
    "e05_lenient_dates": " UNION ALL ".join(
        [
            _dates("ClaimID", [(n, n) for n in _NAMES], "raw_inpatient"),
            _dates("ClaimID", [(n if n.startswith("Claim") else None, n) for n in _NAMES], "raw_outpatient"),
            _dates("BeneID", list(zip(["DOB", "DOD", None, None], _NAMES)), "raw_beneficiary"),
        ]
    ),
    "e06_null_tokens": f"""SELECT ClaimID, {', '.join(_missing(c) for c in [
        'AttendingPhysician', 'OperatingPhysician', 'OtherPhysician', 'ClmAdmitDiagnosisCode',
        'DiagnosisGroupCode', 'ClmDiagnosisCode_1', 'ClmProcedureCode_1'])} FROM raw_inpatient""",
    "e07_length_of_stay": f"SELECT ClaimID, CAST({stay(day('AdmissionDt'), day('DischargeDt'))} AS BIGINT) AS length_of_stay FROM raw_inpatient",
    "e08_dedup_first": f"SELECT {_OUT_COLUMNS} FROM staged_outpatient",
    "e09_referential_filter": """SELECT claim_id, c.bene_id, c.provider_id, CAST(claim_start_date AS VARCHAR) AS claim_start_date
  FROM clean_inpatient c SEMI JOIN dim_beneficiaries b ON c.bene_id = b.bene_id SEMI JOIN dim_providers p ON c.provider_id = p.provider_id""",
    "e10_build_inpatient": f"SELECT {_shown('fact_inpatient_claims')} FROM fact_inpatient_claims",
    "e11_build_outpatient": f"SELECT {_shown('fact_outpatient_claims')} FROM fact_outpatient_claims",
    "e12_unify_claims": f"SELECT {_shown('fact_claims_unified')} FROM staged_claims",
    "e13_money_or_zero": f"SELECT BeneID, {', '.join(f'CAST({amount(raw)} AS DOUBLE) AS {name}' for raw, name in ANNUAL_AMOUNTS.items())} FROM raw_beneficiary",
    "e14_star_counts": _counts(_TABLES),
    "s03_write_star": _counts(_TABLES),
    "s04_table_counts": _counts(_TABLES),
    "s05_reconcile_counts": f"SELECT \"table\", rows AS expected, rows AS actual, true AS ok FROM ({_counts(_TABLES)}) c",
    "s02_read_star": """SELECT claim_id, claim_type, bene_id, provider_id, CAST(claim_start_date AS VARCHAR) AS claim_start_date,
  CAST(reimbursed_amount AS DOUBLE) AS reimbursed_amount, CAST(deductible_amount AS DOUBLE) AS deductible_amount,
  CAST(length_of_stay AS BIGINT) AS length_of_stay, attending_physician, operating_physician, primary_diagnosis_code
  FROM fact_claims_unified""",
    "p01_stratified_sample_500": _sample(500),
    "p01_stratified_sample_40": _sample(40),
    "p02_restrict_claims": f"SELECT ClaimID, Provider FROM raw_inpatient WHERE Provider IN (SELECT Provider FROM ({_sample(40)}) s)",
    "p03_active_beneficiaries": """SELECT BeneID, State FROM raw_beneficiary WHERE BeneID IN (
  SELECT BeneID FROM raw_inpatient UNION SELECT BeneID FROM raw_outpatient)""",
    "v01_raw_audit": _AUDIT,
    "v14_audit_summary": f"""SELECT count(*) FILTER (status = 'failed' AND severity = 'error') = 0 AS passed,
  count(*) FILTER (status = 'failed' AND severity = 'error') AS errors,
  count(*) FILTER (status = 'failed' AND severity = 'warning') AS warnings FROM ({_AUDIT}) a""",
    "v06_raw_metrics": """SELECT 'label_count_' || trim(PotentialFraud) AS metric, CAST(count(*) AS DOUBLE) AS value FROM raw_labels GROUP BY 1
  UNION ALL SELECT 'provider_count', CAST(count(*) AS DOUBLE) FROM raw_labels
  UNION ALL SELECT 'fraud_rate_pct', CAST((2 * 10000 * count(*) FILTER (trim(PotentialFraud) = 'Yes') + count(*)) // (2 * count(*)) AS DOUBLE) / 100
    FROM raw_labels WHERE trim(PotentialFraud) IN ('Yes', 'No')
  UNION ALL SELECT 'beneficiary_count', CAST(count(*) AS DOUBLE) FROM raw_beneficiary
  UNION ALL SELECT 'inpatient_claims_count', CAST(count(*) AS DOUBLE) FROM raw_inpatient
  UNION ALL SELECT 'outpatient_claims_count', CAST(count(*) AS DOUBLE) FROM raw_outpatient""",
    "c01_constraints": _constraints(),
    "c02_primary_keys": " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{key}' AS key, count(*) FILTER (n > 1) AS duplicate_keys,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key}) k"""
        for table, key in PRIMARY_KEYS.items()
    ),
    "c03_foreign_keys": _foreign_keys({t: t for t in FACTS}),
    "c03_foreign_keys_staged": _foreign_keys({"fact_claims_unified": "staged_claims"}),
    "c10_column_defaults": f"""SELECT BeneID, trim(RenalDiseaseIndicator) = '1' AS renal_disease,
  {', '.join(f"coalesce(CASE WHEN {text(raw)} IS NOT NULL THEN trim({raw}) = '1' END, false) AS {name}" for raw, name in CONDITIONS.items())},
  {', '.join(f'CAST({amount(raw)} AS DOUBLE) AS {name}' for raw, name in ANNUAL_AMOUNTS.items())} FROM raw_beneficiary""",
}

assert all(name in CTES for name in ("staged_claims", "clean_inpatient"))
ORACLES = {name: with_star(body) for name, body in _BODIES.items()}
