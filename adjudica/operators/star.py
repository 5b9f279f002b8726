"""Raw text tables to the typed star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.functions import cleanse as c
from adjudica.operators.ranking import first_per_key
from adjudica.schema import ANNUAL_AMOUNTS, CONDITIONS, STAR_SCHEMAS

Star = dict[str, DataFrame]


def dedup_first(df: DataFrame, key: str, first: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by the ``first`` columns, then all others."""
    first = first or []
    rest = [name for name in df.columns if name != key and name not in first]
    return first_per_key(df, key, [F.col(name).asc_nulls_last() for name in first + rest])


def clean_providers(labels: DataFrame) -> DataFrame:
    return labels.select(
        c.clean_id("Provider").alias("provider_id"),
        c.decode_label("PotentialFraud").alias("potential_fraud"),
        F.trim(c.null_tokens("PotentialFraud")).alias("fraud_label"),
    )


def build_providers(labels: DataFrame) -> DataFrame:
    """One row per provider; one that any row flags is flagged (the audit counts conflicts)."""
    order = [F.desc_nulls_last("potential_fraud"), F.asc_nulls_last("fraud_label")]
    return first_per_key(clean_providers(labels), "provider_id", order)


def clean_beneficiaries(raw: DataFrame) -> DataFrame:
    return raw.select(
        c.clean_id("BeneID").alias("bene_id"),
        c.lenient_date("DOB").alias("dob"),
        c.lenient_date("DOD").alias("dod"),
        c.lenient_int("Gender").alias("gender"),
        c.lenient_int("Race").alias("race"),
        c.lenient_int("State").alias("state_id"),
        c.lenient_int("County").alias("county_id"),
        c.decode_renal("RenalDiseaseIndicator").alias("renal_disease"),
        *[c.decode_flag(source).alias(name) for source, name in CONDITIONS.items()],
        *[c.money_or_zero(source).alias(name) for source, name in ANNUAL_AMOUNTS.items()],
    )


def build_beneficiaries(raw: DataFrame) -> DataFrame:
    return dedup_first(clean_beneficiaries(raw), "bene_id")


def _claim_head() -> list:
    return [
        c.clean_id("ClaimID").alias("claim_id"),
        c.clean_id("BeneID").alias("bene_id"),
        c.clean_id("Provider").alias("provider_id"),
        c.lenient_date("ClaimStartDt").alias("claim_start_date"),
        c.lenient_date("ClaimEndDt").alias("claim_end_date"),
    ]


def _claim_body() -> list:
    return [
        c.money_or_zero("InscClaimAmtReimbursed").alias("reimbursed_amount"),
        c.money_or_zero("DeductibleAmtPaid").alias("deductible_amount"),
        c.null_tokens("AttendingPhysician").alias("attending_physician"),
        c.null_tokens("OperatingPhysician").alias("operating_physician"),
        c.null_tokens("OtherPhysician").alias("other_physician"),
    ]


def _claim_codes() -> list:
    return [
        c.null_tokens("ClmDiagnosisCode_1").alias("primary_diagnosis_code"),
        c.null_tokens("ClmProcedureCode_1").alias("primary_procedure_code"),
    ]


def clean_inpatient(raw: DataFrame) -> DataFrame:
    admission, discharge = c.lenient_date("AdmissionDt"), c.lenient_date("DischargeDt")
    return raw.select(
        *_claim_head(),
        admission.alias("admission_date"),
        discharge.alias("discharge_date"),
        c.length_of_stay(admission, discharge).alias("length_of_stay"),
        *_claim_body(),
        c.null_tokens("ClmAdmitDiagnosisCode").alias("admit_diagnosis_code"),
        c.null_tokens("DiagnosisGroupCode").alias("diagnosis_group_code"),
        *_claim_codes(),
    )


def clean_outpatient(raw: DataFrame) -> DataFrame:
    return raw.select(*_claim_head(), *_claim_body(), *_claim_codes())


def referential_filter(
    claims: DataFrame, beneficiaries: DataFrame, providers: DataFrame, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Claims whose provider and beneficiary both exist.

    The callers decide on hints: without one, a dimension below the broadcast
    threshold is broadcast, a larger one is shuffled and a hot key is split by
    the adaptive skew join. For a key in ``missing`` the claims meet its
    ``missing_keys`` instead, which are few where the dimension is large.
    """
    missing = missing or {}
    for key, known in (("provider_id", providers), ("bene_id", beneficiaries)):
        if key in missing:
            claims = claims.where(F.col(key).isNotNull()).join(missing[key], key, "left_anti")
        else:
            claims = claims.join(known.select(key), key, "left_semi")
    return claims


def missing_keys(claims: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the claims that the dimension does not have; only keys are shuffled."""
    keys = claims.select(key).where(F.col(key).isNotNull()).distinct()
    return keys.join(dimension.select(key), key, "left_anti")


def build_inpatient(
    raw: DataFrame, beneficiaries: DataFrame, providers: DataFrame, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    kept = referential_filter(clean_inpatient(raw), beneficiaries, providers, missing)
    return _shaped(dedup_first(kept, "claim_id"), "fact_inpatient_claims")


def build_outpatient(
    raw: DataFrame, beneficiaries: DataFrame, providers: DataFrame, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    kept = referential_filter(clean_outpatient(raw), beneficiaries, providers, missing)
    return _shaped(dedup_first(kept, "claim_id"), "fact_outpatient_claims")


def unify_claims(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """Both claim kinds in one narrow fact; an outpatient claim has stay 0."""
    tagged = inpatient.withColumn("claim_type", F.lit("Inpatient")).unionByName(
        outpatient.withColumn("claim_type", F.lit("Outpatient")).withColumn("length_of_stay", F.lit(0)),
        allowMissingColumns=True,
    )
    return _shaped(tagged, "fact_claims_unified")


def claim_keys(raw: dict[str, DataFrame]) -> DataFrame:
    """(claim_id, provider_id, bene_id) of every claim the load reads, repeated ids included."""
    inpatient, outpatient = clean_inpatient(raw["inpatient"]), clean_outpatient(raw["outpatient"])
    keys = ["claim_id", "provider_id", "bene_id"]
    return inpatient.select(keys).union(outpatient.select(keys))


def staged_claims(raw: dict[str, DataFrame]) -> DataFrame:
    """Cleaned, unique claims before the referential filter."""
    inpatient = dedup_first(clean_inpatient(raw["inpatient"]), "claim_id")
    outpatient = dedup_first(clean_outpatient(raw["outpatient"]), "claim_id")
    return unify_claims(inpatient, outpatient)


def build_star(raw: dict[str, DataFrame]) -> Star:
    providers = build_providers(raw["labels"])
    beneficiaries = build_beneficiaries(raw["beneficiary"])
    inpatient = build_inpatient(raw["inpatient"], beneficiaries, providers)
    outpatient = build_outpatient(raw["outpatient"], beneficiaries, providers)
    return {
        "dim_providers": providers,
        "dim_beneficiaries": beneficiaries,
        "fact_inpatient_claims": inpatient,
        "fact_outpatient_claims": outpatient,
        "fact_claims_unified": unify_claims(inpatient, outpatient),
    }


def apply_defaults(beneficiaries: DataFrame) -> DataFrame:
    """Declared column defaults: missing condition flags are false, amounts 0."""
    flags = ["renal_disease", *CONDITIONS.values()]
    return beneficiaries.fillna(False, subset=flags).fillna(
        0, subset=list(ANNUAL_AMOUNTS.values())
    )


def default_stay(claims: DataFrame) -> DataFrame:
    """Declared default of the unified fact: a missing stay is 0 days."""
    return claims.fillna(0, subset=["length_of_stay"])


def _shaped(df: DataFrame, table: str) -> DataFrame:
    return df.select(*STAR_SCHEMAS[table].fieldNames())
