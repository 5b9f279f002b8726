import datetime

import pytest
from pyspark.sql import functions as F

from adjudica.operators import quality
from adjudica.schema import REQUIRED_COLUMNS
from conftest import claim, frame, provider, star_of

AS_OF = datetime.date(2024, 1, 1)


def valid(spark):
    return {
        "labels": spark.createDataFrame([("P1", "Yes")], "Provider string, PotentialFraud string"),
        "beneficiary": spark.createDataFrame([("B1", "1950-01-01", "NA", "1", "1", "1", "10")], "BeneID string, DOB string, DOD string, Gender string, Race string, State string, County string"),
        "inpatient": spark.createDataFrame([("B1", "C1", "2009-01-01", "2009-01-05", "P1", "5000.0", "2009-01-01", "2009-01-05")], ", ".join(f"{c} string" for c in REQUIRED_COLUMNS["inpatient"])),
        "outpatient": spark.createDataFrame([("B1", "C2", "2009-02-01", "2009-02-01", "P1", "200.0")], ", ".join(f"{c} string" for c in REQUIRED_COLUMNS["outpatient"])),
    }


def failures(report):
    return {(r["table"], r["rule"]): r["violations"] for r in report.collect() if r["status"] == "failed"}


def test_valid_tables_pass(spark):
    report = quality.audit(spark, valid(spark), AS_OF)
    assert failures(report) == {}
    summary = quality.audit_summary(quality.enforce(report)).first()
    assert (summary["passed"], summary["errors"], summary["warnings"]) == (True, 0, 0)


def test_missing_tables_and_columns_are_reported(spark):
    tables = valid(spark)
    only = failures(quality.audit(spark, {"labels": tables["labels"]}, AS_OF))
    assert {table for table, rule in only if rule == "required_table"} == {"beneficiary", "inpatient", "outpatient"}
    tables["beneficiary"] = tables["beneficiary"].drop("DOD", "State")
    report = quality.audit(spark, tables, AS_OF)
    assert failures(report) == {("beneficiary", "required_columns"): 1}
    skipped = [(r["table"], r["rule"], r["violations"]) for r in report.collect() if r["status"] == "skipped"]
    assert ("beneficiary", "death_before_birth", None) in skipped and ("beneficiary", "unreadable_date", None) in skipped


def test_leakage_column_is_an_error(spark):
    tables = valid(spark)
    tables["inpatient"] = tables["inpatient"].withColumn("RecoveryAmount", F.lit(1000.0))
    report = quality.audit(spark, tables, AS_OF)
    assert failures(report) == {("inpatient", "leakage_columns"): 1}
    with pytest.raises(quality.DataQualityError, match="leakage_columns"):
        quality.enforce(report)


def test_each_rule_counts_its_rows(spark):
    tables = valid(spark)
    tables["labels"] = spark.createDataFrame([("P1", "Yes"), ("P1", "0"), (None, None), (None, "Maybe")], "Provider string, PotentialFraud string")
    tables["beneficiary"] = tables["beneficiary"].union(
        spark.createDataFrame([("B2", "2050-01-01", "1900-01-01", "1", "1", "1", "1"), ("B3", "bad", "1900-01-01", "1", "1", "1", "1")], tables["beneficiary"].schema))
    row = ("B1", "C1", "2009-01-01", "2009-01-05", "P1", "-500.0", "2009-01-09", "2009-01-05")
    tables["inpatient"] = tables["inpatient"].union(spark.createDataFrame([row], tables["inpatient"].schema))
    tables["outpatient"] = tables["outpatient"].withColumn("InscClaimAmtReimbursed", F.lit("-1"))
    report = quality.audit(spark, tables, AS_OF)
    assert failures(report) == {
        ("labels", "label_domain"): 1, ("labels", "duplicate_providers"): 2, ("labels", "missing_id"): 2, ("labels", "conflicting_labels"): 1,
        ("beneficiary", "unreadable_date"): 1, ("beneficiary", "birth_in_future"): 1, ("beneficiary", "death_before_birth"): 1,
        ("inpatient", "negative_reimbursement"): 1, ("inpatient", "discharge_before_admission"): 1,
        ("inpatient", "duplicate_claims"): 1, ("outpatient", "negative_reimbursement"): 1,
    }
    summary = quality.audit_summary(report).first()
    assert (summary["passed"], summary["errors"], summary["warnings"]) == (False, 8, 3)


def test_metrics_ignore_unknown_labels_in_the_rate(spark):
    tables = valid(spark)
    tables["labels"] = spark.createDataFrame([("P1", "Yes"), ("P2", "No"), ("P3", "No "), ("P4", "1"), ("P5", None)], "Provider string, PotentialFraud string")
    got = {r["metric"]: r["value"] for r in quality.raw_metrics(tables).collect()}
    assert got["fraud_rate_pct"] == 33.33 and got["provider_count"] == 5
    assert got["label_count_No"] == 2 and got["label_count_missing"] == 1
    assert got["inpatient_claims_count"] == 1


def test_constraints_keys_and_references(spark):
    good = claim("C1", "Inpatient", "B1", "P1", "2009-01-01", 10)
    bad = claim("C1", "Elsewhere", "B9", None, None, -1, -2, -3, doctor="x" * 31)
    star = star_of(spark, [provider("P1", True), provider("P2", None) | {"fraud_label": "Maybe"}], [], [good])
    star["fact_claims_unified"] = frame(spark, "fact_claims_unified", [good, bad])
    rules = {(r["table"], r["column"], r["rule"]): r["violations"] for r in quality.constraint_audit(star).collect()}
    fact = "fact_claims_unified"
    assert rules[(fact, "provider_id", "not_null")] == 1 and rules[(fact, "claim_start_date", "not_null")] == 1
    assert rules[(fact, "claim_type", "check_domain")] == 1 and rules[(fact, "reimbursed_amount", "check_not_negative")] == 1
    assert rules[(fact, "attending_physician", "max_length")] == 1
    assert rules[("dim_providers", "fraud_label", "check_domain")] == 1 and rules[("dim_providers", "potential_fraud", "not_null")] == 1
    keys = {r["table"]: (r["duplicate_keys"], r["surplus_rows"]) for r in quality.primary_key_audit(star).collect()}
    assert keys[fact] == (1, 1) and keys["dim_beneficiaries"] == (0, 0)
    references = {(r["table"], r["column"]): r["violations"] for r in quality.foreign_key_audit(star, star["dim_providers"], star["dim_beneficiaries"]).collect()}
    assert references[(fact, "bene_id")] == 2 and references[(fact, "provider_id")] == 0
