"""Table shapes and fixed values of the claims model."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Raw condition column -> star condition column, source spelling.
CONDITIONS = {
    "ChronicCond_Alzheimer": "chronic_alzheimer",
    "ChronicCond_Heartfailure": "chronic_heartfailure",
    "ChronicCond_KidneyDisease": "chronic_kidneydisease",
    "ChronicCond_Cancer": "chronic_cancer",
    "ChronicCond_ObstrPulmonary": "chronic_copd",
    "ChronicCond_Depression": "chronic_depression",
    "ChronicCond_Diabetes": "chronic_diabetes",
    "ChronicCond_IschemicHeart": "chronic_ischemicheart",
    "ChronicCond_Osteoporasis": "chronic_osteoporosis",
    "ChronicCond_rheumatoidarthritis": "chronic_rheumatoidarthritis",
    "ChronicCond_stroke": "chronic_stroke",
}
CHRONIC_FLAGS = list(CONDITIONS.values())

# Raw annual amount column -> star column.
ANNUAL_AMOUNTS = {
    "IPAnnualReimbursementAmt": "ip_annual_reimbursement",
    "IPAnnualDeductibleAmt": "ip_annual_deductible",
    "OPAnnualReimbursementAmt": "op_annual_reimbursement",
    "OPAnnualDeductibleAmt": "op_annual_deductible",
}

# Texts that mean "missing" in the raw files.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Columns only known after an investigation.
LEAKAGE_COLUMNS = [
    "AuditResult", "RecoveryAmount", "InvestigationStatus", "ProsecutionDate",
    "SettlementAmount", "FraudOutcome", "FraudConfidenceScore",
]

# Columns each raw table must bring.
REQUIRED_COLUMNS = {
    "labels": ["Provider", "PotentialFraud"],
    "beneficiary": ["BeneID", "DOB", "Gender", "Race", "State", "County"],
    "inpatient": [
        "BeneID", "ClaimID", "ClaimStartDt", "ClaimEndDt", "Provider",
        "InscClaimAmtReimbursed", "AdmissionDt", "DischargeDt",
    ],
    "outpatient": [
        "BeneID", "ClaimID", "ClaimStartDt", "ClaimEndDt", "Provider",
        "InscClaimAmtReimbursed",
    ],
}

_CLAIM_HEAD = [
    "BeneID", "ClaimID", "ClaimStartDt", "ClaimEndDt", "Provider",
    "InscClaimAmtReimbursed", "DeductibleAmtPaid",
]
_PHYSICIANS = ["AttendingPhysician", "OperatingPhysician", "OtherPhysician"]

RAW_COLUMNS = {
    "labels": ["Provider", "PotentialFraud"],
    "beneficiary": [
        "BeneID", "DOB", "DOD", "Gender", "Race", "State", "County",
        "RenalDiseaseIndicator", *CONDITIONS, *ANNUAL_AMOUNTS,
    ],
    "inpatient": [
        *_CLAIM_HEAD, "AdmissionDt", "DischargeDt", *_PHYSICIANS,
        "ClmAdmitDiagnosisCode", "DiagnosisGroupCode", "ClmDiagnosisCode_1",
        "ClmProcedureCode_1",
    ],
    "outpatient": [*_CLAIM_HEAD, *_PHYSICIANS, "ClmDiagnosisCode_1", "ClmProcedureCode_1"],
}


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


_TEXT, _DATE, _INT, _FLAG = T.StringType(), T.DateType(), T.IntegerType(), T.BooleanType()

_KEYS = [("claim_id", _TEXT), ("bene_id", _TEXT), ("provider_id", _TEXT)]
_SPAN = [("claim_start_date", _DATE), ("claim_end_date", _DATE)]
_AMOUNTS = [("reimbursed_amount", MONEY), ("deductible_amount", MONEY)]
_DOCTORS = [("attending_physician", _TEXT), ("operating_physician", _TEXT), ("other_physician", _TEXT)]

STAR_SCHEMAS = {
    "dim_providers": _struct(
        [("provider_id", _TEXT), ("potential_fraud", _FLAG), ("fraud_label", _TEXT)]
    ),
    "dim_beneficiaries": _struct(
        [
            ("bene_id", _TEXT), ("dob", _DATE), ("dod", _DATE), ("gender", _INT),
            ("race", _INT), ("state_id", _INT), ("county_id", _INT), ("renal_disease", _FLAG),
        ]
        + [(name, _FLAG) for name in CHRONIC_FLAGS]
        + [(name, MONEY) for name in ANNUAL_AMOUNTS.values()]
    ),
    "fact_inpatient_claims": _struct(
        _KEYS + _SPAN
        + [("admission_date", _DATE), ("discharge_date", _DATE), ("length_of_stay", _INT)]
        + _AMOUNTS + _DOCTORS
        + [
            ("admit_diagnosis_code", _TEXT), ("diagnosis_group_code", _TEXT),
            ("primary_diagnosis_code", _TEXT), ("primary_procedure_code", _TEXT),
        ]
    ),
    "fact_outpatient_claims": _struct(
        _KEYS + _SPAN + _AMOUNTS + _DOCTORS
        + [("primary_diagnosis_code", _TEXT), ("primary_procedure_code", _TEXT)]
    ),
    "fact_claims_unified": _struct(
        [("claim_id", _TEXT), ("claim_type", _TEXT), ("bene_id", _TEXT), ("provider_id", _TEXT)]
        + _SPAN + _AMOUNTS
        + [
            ("length_of_stay", _INT), ("attending_physician", _TEXT),
            ("operating_physician", _TEXT), ("primary_diagnosis_code", _TEXT),
        ]
    ),
}

PRIMARY_KEYS = {
    "dim_providers": "provider_id",
    "dim_beneficiaries": "bene_id",
    "fact_inpatient_claims": "claim_id",
    "fact_outpatient_claims": "claim_id",
    "fact_claims_unified": "claim_id",
}
FACTS = ["fact_inpatient_claims", "fact_outpatient_claims", "fact_claims_unified"]

# Columns that may not be null, per table.
NOT_NULL = {
    "dim_providers": ["provider_id", "potential_fraud", "fraud_label"],
    "dim_beneficiaries": [
        "bene_id", "dob", "gender", "race", "state_id", "county_id", "renal_disease",
        *CHRONIC_FLAGS,
    ],
    "fact_inpatient_claims": [
        "claim_id", "bene_id", "provider_id", "claim_start_date", "claim_end_date",
        "admission_date", "discharge_date", "length_of_stay", "reimbursed_amount",
        "deductible_amount",
    ],
    "fact_outpatient_claims": [
        "claim_id", "bene_id", "provider_id", "claim_start_date", "claim_end_date",
        "reimbursed_amount", "deductible_amount",
    ],
    "fact_claims_unified": [
        "claim_id", "claim_type", "bene_id", "provider_id", "claim_start_date",
        "claim_end_date", "reimbursed_amount", "deductible_amount", "length_of_stay",
    ],
}

# Declared text lengths, per table and column.
MAX_LENGTHS = {
    "dim_providers": {"provider_id": 30, "fraud_label": 5},
    "dim_beneficiaries": {"bene_id": 30},
    "fact_inpatient_claims": {
        "claim_id": 30, "bene_id": 30, "provider_id": 30, "attending_physician": 30,
        "operating_physician": 30, "other_physician": 30, "admit_diagnosis_code": 20,
        "diagnosis_group_code": 20, "primary_diagnosis_code": 20, "primary_procedure_code": 20,
    },
    "fact_outpatient_claims": {
        "claim_id": 30, "bene_id": 30, "provider_id": 30, "attending_physician": 30,
        "operating_physician": 30, "other_physician": 30, "primary_diagnosis_code": 20,
        "primary_procedure_code": 20,
    },
    "fact_claims_unified": {
        "claim_id": 30, "claim_type": 15, "bene_id": 30, "provider_id": 30,
        "attending_physician": 30, "operating_physician": 30, "primary_diagnosis_code": 20,
    },
}


def raw_schema(table: str) -> T.StructType:
    """Raw files are read as text; typing happens in the star step."""
    return _struct([(name, _TEXT) for name in RAW_COLUMNS[table]])
