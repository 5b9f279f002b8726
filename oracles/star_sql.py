"""The star schema in plain SQL, as common table expressions."""

from __future__ import annotations

from adjudica.schema import ANNUAL_AMOUNTS, CHRONIC_FLAGS, CONDITIONS, NA_TOKENS, STAR_SCHEMAS
from adjudica.sources.testdata import RAW_SQL

_TOKENS = ", ".join(f"'{token}'" for token in NA_TOKENS)


def text(column: str) -> str:
    return f"CASE WHEN trim({column}) IN ({_TOKENS}) THEN NULL ELSE {column} END"


def ident(column: str) -> str:
    return f"trim({text(column)})"


def day(column: str) -> str:
    # Days with or without a time of day; a bare year is not a day.
    parsed = f"strptime(regexp_extract(trim({column}), '^([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}})([ T]|$)', 1)"
    return f"CAST(try_{parsed}, '%Y-%m-%d') AS DATE)"


def amount(column: str) -> str:
    return f"coalesce(TRY_CAST(trim({column}) AS DECIMAL(12,2)), 0.00)"


def flag(column: str) -> str:
    return f"coalesce(trim({column}) = '1', false)"


def renal(column: str) -> str:
    return f"coalesce(upper({column}) IN ('Y', '1', 'TRUE'), false)"


def stay(admission: str, discharge: str) -> str:
    return f"CAST(coalesce(greatest({discharge} - {admission}, 0), 0) AS INTEGER)"


def first(source: str, key: str, columns: list[str], order: list[str]) -> str:
    sort = ", ".join(f"{name} ASC NULLS LAST" for name in order)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {sort}) AS rn"
        f" FROM {source}) t WHERE rn = 1"
    )


_PROVIDERS_CLEAN = f"""SELECT {ident('Provider')} AS provider_id,
  CASE trim(PotentialFraud) WHEN 'Yes' THEN true WHEN 'No' THEN false END AS potential_fraud,
  trim({text('PotentialFraud')}) AS fraud_label FROM raw_labels"""

_BENE_CLEAN = f"""SELECT {ident('BeneID')} AS bene_id, {day('DOB')} AS dob, {day('DOD')} AS dod,
  TRY_CAST(trim(Gender) AS INTEGER) AS gender, TRY_CAST(trim(Race) AS INTEGER) AS race,
  TRY_CAST(trim(State) AS INTEGER) AS state_id, TRY_CAST(trim(County) AS INTEGER) AS county_id,
  {renal('RenalDiseaseIndicator')} AS renal_disease,
  {', '.join(f'{flag(raw)} AS {name}' for raw, name in CONDITIONS.items())},
  {', '.join(f'{amount(raw)} AS {name}' for raw, name in ANNUAL_AMOUNTS.items())} FROM raw_beneficiary"""

_HEAD = f"""{ident('ClaimID')} AS claim_id, {ident('BeneID')} AS bene_id, {ident('Provider')} AS provider_id,
  {day('ClaimStartDt')} AS claim_start_date, {day('ClaimEndDt')} AS claim_end_date"""
_BODY = f"""{amount('InscClaimAmtReimbursed')} AS reimbursed_amount, {amount('DeductibleAmtPaid')} AS deductible_amount,
  {text('AttendingPhysician')} AS attending_physician, {text('OperatingPhysician')} AS operating_physician,
  {text('OtherPhysician')} AS other_physician"""
_CODES = f"""{text('ClmDiagnosisCode_1')} AS primary_diagnosis_code, {text('ClmProcedureCode_1')} AS primary_procedure_code"""

_INP_CLEAN = f"""SELECT {_HEAD}, {day('AdmissionDt')} AS admission_date, {day('DischargeDt')} AS discharge_date,
  {stay(day('AdmissionDt'), day('DischargeDt'))} AS length_of_stay, {_BODY},
  {text('ClmAdmitDiagnosisCode')} AS admit_diagnosis_code, {text('DiagnosisGroupCode')} AS diagnosis_group_code,
  {_CODES} FROM raw_inpatient"""
_OUT_CLEAN = f"SELECT {_HEAD}, {_BODY}, {_CODES} FROM raw_outpatient"


def _cols(table: str) -> list[str]:
    return STAR_SCHEMAS[table].fieldNames()


def _rest(table: str, key: str) -> list[str]:
    return [name for name in _cols(table) if name != key]


def _kept(clean: str) -> str:
    return (
        f"(SELECT c.* FROM {clean} c SEMI JOIN dim_beneficiaries b ON c.bene_id = b.bene_id"
        " SEMI JOIN dim_providers p ON c.provider_id = p.provider_id) k"
    )


_SHARED = [name for name in _cols("fact_claims_unified") if name not in ("claim_type", "length_of_stay")]


def _unified(inpatient: str, outpatient: str) -> str:
    shared = ", ".join(_SHARED)
    return (
        f"SELECT {shared}, 'Inpatient' AS claim_type, length_of_stay FROM {inpatient} UNION ALL "
        f"SELECT {shared}, 'Outpatient' AS claim_type, 0 AS length_of_stay FROM {outpatient}"
    )


def _first_star(source: str, table: str, key: str) -> str:
    return first(source, key, _cols(table), _rest(table, key))


CTES = {
    "raw_labels": RAW_SQL["labels"],
    "raw_beneficiary": RAW_SQL["beneficiary"],
    "raw_inpatient": RAW_SQL["inpatient"],
    "raw_outpatient": RAW_SQL["outpatient"],
    "clean_providers": _PROVIDERS_CLEAN,
    "clean_beneficiaries": _BENE_CLEAN,
    "clean_inpatient": _INP_CLEAN,
    "clean_outpatient": _OUT_CLEAN,
    "dim_providers": """SELECT provider_id, bool_or(potential_fraud) AS potential_fraud,
  coalesce(max(fraud_label) FILTER (potential_fraud), min(fraud_label) FILTER (NOT potential_fraud), min(fraud_label)) AS fraud_label
  FROM clean_providers GROUP BY provider_id""",
    "dim_beneficiaries": _first_star("clean_beneficiaries", "dim_beneficiaries", "bene_id"),
    "staged_inpatient": _first_star("clean_inpatient", "fact_inpatient_claims", "claim_id"),
    "staged_outpatient": _first_star("clean_outpatient", "fact_outpatient_claims", "claim_id"),
    "read_claims": "SELECT claim_id, provider_id, bene_id FROM clean_inpatient UNION ALL SELECT claim_id, provider_id, bene_id FROM clean_outpatient",
    "staged_claims": _unified("staged_inpatient", "staged_outpatient"),
    "fact_inpatient_claims": _first_star(_kept("clean_inpatient"), "fact_inpatient_claims", "claim_id"),
    "fact_outpatient_claims": _first_star(_kept("clean_outpatient"), "fact_outpatient_claims", "claim_id"),
    "fact_claims_unified": _unified("fact_inpatient_claims", "fact_outpatient_claims"),
}


def _words(sql: str) -> set[str]:
    for sign in "(),;=\n":
        sql = sql.replace(sign, " ")
    return {part.split(".")[0] for part in sql.split()}


def with_star(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the definitions it needs, directly or through others."""
    known = {**CTES, **(extra or {})}
    needed: set[str] = set()
    todo = _words(body) & set(known)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= (_words(known[name]) & set(known)) - needed
    parts = [f"{name} AS MATERIALIZED ({sql.strip()})" for name, sql in known.items() if name in needed]
    return f"WITH {', '.join(parts)}\n{body.strip()}" if parts else body.strip()


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def half_up(total: str, count: str) -> str:
    return f"((2 * ({total}) + {count}) // (2 * {count}))"


CENTS = "CAST(sum(reimbursed_amount) * 100 AS BIGINT)"
DEDUCT_CENTS = "CAST(sum(deductible_amount) * 100 AS BIGINT)"
ONE_CENTS = "CAST(reimbursed_amount * 100 AS BIGINT)"
MONTH = "strftime(claim_start_date, '%Y-%m')"
AGE_FLAGS = CHRONIC_FLAGS
