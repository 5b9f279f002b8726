"""Shared session and hand-checkable tables."""

from __future__ import annotations

import datetime
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adjudica.schema import ANNUAL_AMOUNTS, CHRONIC_FLAGS, STAR_SCHEMAS  # noqa: E402
from adjudica.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=8)


def day(text):
    return datetime.date.fromisoformat(text) if text else None


def frame(spark, table, rows):
    """Star table from dicts; columns left out are null."""
    schema = STAR_SCHEMAS[table]
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields) for row in rows], schema)


def provider(key, fraud):
    return {"provider_id": key, "potential_fraud": fraud, "fraud_label": {True: "Yes", False: "No"}.get(fraud)}


def bene(key, born="1950-01-01", state=1, gender=1, renal=False, flags=()):
    row = {name: name in flags for name in CHRONIC_FLAGS}
    row |= {name: Decimal("0.00") for name in ANNUAL_AMOUNTS.values()}
    return row | {
        "bene_id": key, "dob": day(born), "gender": gender, "race": 1, "state_id": state,
        "county_id": 10, "renal_disease": renal,
    }


def claim(key, kind, bene_id, provider_id, start, paid, deducted="0.00", stay=0, doctor=None, operator=None, code=None, end=None):
    return {
        "claim_id": key, "claim_type": kind, "bene_id": bene_id, "provider_id": provider_id,
        "claim_start_date": day(start), "claim_end_date": day(end or start),
        "reimbursed_amount": Decimal(str(paid)), "deductible_amount": Decimal(str(deducted)),
        "length_of_stay": stay, "attending_physician": doctor, "operating_physician": operator,
        "primary_diagnosis_code": code,
    }


def star_of(spark, providers, benes, claims, procedures=None):
    """All five tables; inpatient and outpatient facts follow from the claims."""
    inpatient = [
        c | {
            "admission_date": c["claim_start_date"], "discharge_date": c["claim_end_date"],
            "admit_diagnosis_code": c["primary_diagnosis_code"],
            "primary_procedure_code": (procedures or {}).get(c["claim_id"]),
        }
        for c in claims if c["claim_type"] == "Inpatient"
    ]
    outpatient = [c for c in claims if c["claim_type"] == "Outpatient"]
    return {
        "dim_providers": frame(spark, "dim_providers", providers),
        "dim_beneficiaries": frame(spark, "dim_beneficiaries", benes),
        "fact_inpatient_claims": frame(spark, "fact_inpatient_claims", inpatient),
        "fact_outpatient_claims": frame(spark, "fact_outpatient_claims", outpatient),
        "fact_claims_unified": frame(spark, "fact_claims_unified", claims),
    }


@pytest.fixture(scope="session")
def small_star(spark):
    """4 providers (2 flagged), 4 patients in 2 states, 4 inpatient and 5 outpatient claims."""
    inp, out = "Inpatient", "Outpatient"
    claims = [
        claim("S1", inp, "A", "N1", "2011-05-02", 7200, 600, 10, "KA", end="2011-05-12"),
        claim("S2", inp, "C", "N1", "2011-06-20", 5600, 600, 4, "KB", end="2011-06-24"),
        claim("S3", inp, "D", "N3", "2011-05-28", 8800, 400, 8, "KC", end="2011-06-05"),
        claim("S4", inp, "B", "N2", "2011-07-01", 5100, 500, 2, "KD", end="2011-07-03"),
        claim("T1", out, "A", "N2", "2011-05-09", 200, 20, 0, "KD"),
        claim("T2", out, "B", "N2", "2011-06-11", 150, 10, 0, "KD"),
        claim("T3", out, "C", "N4", "2011-07-19", 360, 30, 0, "KE"),
        claim("T4", out, "D", "N4", "2011-07-19", 240, 0, 0, "KE"),
        claim("T5", out, "A", "N1", "2011-06-20", 350, 40, 0, "KA"),
    ]
    providers = [provider("N1", True), provider("N2", False), provider("N3", True), provider("N4", False)]
    benes = [bene("A", "1938-08-01", state=3), bene("B", "1971-12-24", state=3, gender=2), bene("C", state=8), bene("D", state=8)]
    return star_of(spark, providers, benes, claims)


@pytest.fixture(scope="session")
def feature_star(spark):
    """Three providers with 9 claims in 2012, and a fourth without any."""
    inp, out = "Inpatient", "Outpatient"
    claims = [
        claim("K1", inp, "U", "X1", "2012-03-04", 2400, 100, 6, "R1", "R9", "250"),
        claim("K2", inp, "V", "X1", "2012-03-08", 1600, 100, 3, "R2", None, "486"),
        claim("K3", out, "U", "X1", "2012-03-04", 0, 0, 0, "R1", None, "250"),
        claim("K4", out, "U", "X1", "2012-05-01", 400, 20),
        claim("K5", out, "V", "X1", "2012-03-08", 100, 0, 0, "R2", None, "401"),
        claim("K6", out, "W", "X2", "2012-04-10", 75, 0, 0, "R3", None, "786"),
        claim("K7", out, "W", "X2", "2012-04-10", 125, 0, 0, "R3", None, "786"),
        claim("K8", out, "W", "X2", "2012-04-10", 50),
        claim("K9", out, "V", "X3", "2012-01-02", 90, 5, 0, "R2", None, "401"),
    ]
    benes = [
        bene("U", "1941-06-30", flags=("chronic_cancer", "chronic_stroke")),
        bene("V", "1975-02-11", 5, 2, True, ("chronic_diabetes",)),
        bene("W", None, flags=("chronic_osteoporosis", "chronic_copd", "chronic_depression")),
    ]
    providers = [provider("X1", False), provider("X2", True), provider("X3", False), provider("X4", True)]
    return star_of(spark, providers, benes, claims, {"K1": "0066", "K2": "8154"})
