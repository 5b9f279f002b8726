"""Data-quality rules on the raw tables and declared constraints on the star.

Every rule of a table is one conditional count in that table's single
aggregate. Only uniqueness and foreign keys need a shuffle; both first add up
the rows per key, so a repeated key travels as one row per task.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions.cleanse import amount_too_large, clean_id, decode_label, lenient_date, unreadable_amount, unreadable_date
from adjudica.functions.money import from_units, scaled_ratio
from adjudica.schema import (
    ANNUAL_AMOUNTS,
    FACTS,
    LEAKAGE_COLUMNS,
    MAX_LENGTHS,
    NOT_NULL,
    PRIMARY_KEYS,
    REQUIRED_COLUMNS,
)

ERROR, WARNING = "error", "warning"
VALID_LABELS = ["Yes", "No", "0", "1"]
CLAIM_IDS = ["ClaimID", "BeneID", "Provider"]
CLAIM_DATES = ["ClaimStartDt", "ClaimEndDt"]
CLAIM_AMOUNTS = ["InscClaimAmtReimbursed", "DeductibleAmtPaid"]


class DataQualityError(Exception):
    """An error rule found violations."""


def _number(name: str) -> Column:
    return F.trim(F.col(name)).try_cast("double")


def _any(test, names: list[str]) -> Column:
    """Rows in which one of the columns fails."""
    found = test(names[0])
    for name in names[1:]:
        found = found | test(name)
    return F.count_if(found)


def _missing(name: str) -> Column:
    return clean_id(name).isNull()


def _reading(ids: list[str], dates: list[str], amounts: list[str]) -> list[tuple[str, str, list[str], Column]]:
    """What the typed tables would lose in reading."""
    return [
        ("missing_id", ERROR, ids, _any(_missing, ids)),
        ("unreadable_date", WARNING, dates, _any(unreadable_date, dates)),
        ("unreadable_amount", ERROR, amounts, _any(unreadable_amount, amounts)),
        ("amount_too_large", ERROR, amounts, _any(amount_too_large, amounts)),
    ]


def _duplicates(name: str) -> Column:
    """Rows minus distinct values, NULL being one value."""
    distinct = F.count_distinct(name) + F.max(F.when(F.col(name).isNull(), 1).otherwise(0))
    return F.count("*") - F.coalesce(distinct, F.lit(0))


# (rule, severity, columns it reads, violations as an aggregate)
def _raw_rules(as_of: datetime.date) -> dict[str, list[tuple[str, str, list[str], Column]]]:
    born, died = lenient_date("DOB"), lenient_date("DOD")
    return {
        "labels": [
            ("label_domain", ERROR, ["PotentialFraud"], F.count_if(~F.trim("PotentialFraud").isin(VALID_LABELS))),
            ("duplicate_providers", ERROR, ["Provider"], _duplicates("Provider")),
            ("missing_id", ERROR, ["Provider"], _any(_missing, ["Provider"])),
            (
                "conflicting_labels", ERROR, ["Provider", "PotentialFraud"],
                F.count_distinct(F.trim("Provider"), F.trim("PotentialFraud"))
                - F.count_distinct(F.when(F.col("PotentialFraud").isNotNull(), F.trim("Provider"))),
            ),
        ],
        "beneficiary": [
            ("birth_in_future", ERROR, ["DOB"], F.count_if(born > F.lit(as_of))),
            ("death_before_birth", ERROR, ["DOB", "DOD"], F.count_if(died < born)),
            *_reading(["BeneID"], ["DOB", "DOD"], list(ANNUAL_AMOUNTS)),
        ],
        "inpatient": [
            ("negative_reimbursement", ERROR, ["InscClaimAmtReimbursed"], F.count_if(_number("InscClaimAmtReimbursed") < 0)),
            (
                "discharge_before_admission", WARNING, ["AdmissionDt", "DischargeDt"],
                F.count_if(lenient_date("DischargeDt") < lenient_date("AdmissionDt")),
            ),
            ("duplicate_claims", WARNING, ["ClaimID"], _duplicates("ClaimID")),
            *_reading(CLAIM_IDS, [*CLAIM_DATES, "AdmissionDt", "DischargeDt"], CLAIM_AMOUNTS),
        ],
        "outpatient": [
            ("negative_reimbursement", ERROR, ["InscClaimAmtReimbursed"], F.count_if(_number("InscClaimAmtReimbursed") < 0)),
            *_reading(CLAIM_IDS, CLAIM_DATES, CLAIM_AMOUNTS),
        ],
    }


def _row(rule: str, severity: str, table: str, violations: Column) -> Column:
    violations = violations.cast("bigint")
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        F.lit(table).alias("table"),
        violations.alias("violations"),
        F.when(violations.isNull(), "skipped").when(violations == 0, "passed").otherwise("failed").alias("status"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def schema_audit(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Required tables and columns present, leakage columns absent."""
    rows = []
    for table, required in REQUIRED_COLUMNS.items():
        present = tables[table].columns if table in tables else None
        rows.append(_row("required_table", ERROR, table, F.lit(int(present is None))))
        if present is not None:
            missing = len(set(required) - set(present))
            rows.append(_row("required_columns", ERROR, table, F.lit(missing)))
    for table, df in tables.items():
        found = len(set(df.columns) & set(LEAKAGE_COLUMNS))
        rows.append(_row("leakage_columns", ERROR, table, F.lit(found)))
    return spark.range(1).select(F.inline(F.array(*rows)))


def rule_audit(tables: dict[str, DataFrame], as_of: datetime.date) -> DataFrame:
    """Domain, range and uniqueness rules; a rule without its columns is skipped."""
    parts = []
    for table, rules in _raw_rules(as_of).items():
        if table not in tables:
            continue
        df = tables[table]
        names = [f"v{i}" for i in range(len(rules))]
        known = [set(columns) <= set(df.columns) for _, _, columns, _ in rules]
        counts = df.agg(
            F.count("*").alias("_rows"),
            *[rule[3].alias(name) for rule, name, ok in zip(rules, names, known) if ok],
        )
        rows = [
            _row(rule, severity, table, F.col(name) if ok else F.lit(None))
            for (rule, severity, _, _), name, ok in zip(rules, names, known)
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return _union(parts)


def audit(spark: SparkSession, tables: dict[str, DataFrame], as_of: datetime.date | None = None) -> DataFrame:
    """(rule, severity, table, violations, status) for all raw rules."""
    as_of = as_of or datetime.date.today()
    return schema_audit(spark, tables).unionByName(rule_audit(tables, as_of))


def audit_summary(report: DataFrame) -> DataFrame:
    """Overall result with the number of failed error and warning rules."""
    failed = F.col("status") == "failed"
    errors = F.count_if(failed & (F.col("severity") == ERROR))
    return report.agg(
        (errors == 0).alias("passed"),
        errors.alias("errors"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warnings"),
    )


def enforce(report: DataFrame) -> DataFrame:
    """Raise when an error rule failed; the report is complete by then."""
    failed = report.where((F.col("status") == "failed") & (F.col("severity") == ERROR)).collect()
    if failed:
        raise DataQualityError(
            "; ".join(f"{row['table']}: {row['rule']} ({row['violations']})" for row in failed)
        )
    return report


def raw_metrics(tables: dict[str, DataFrame]) -> DataFrame:
    """(metric, value): table sizes, label counts and the fraud rate in percent."""
    parts = []
    if "labels" in tables:
        per_label = tables["labels"].groupBy("PotentialFraud").agg(F.count("*").alias("n"))
        label = F.trim(F.coalesce("PotentialFraud", F.lit("missing")))
        parts.append(
            per_label.groupBy(F.concat(F.lit("label_count_"), label).alias("metric")).agg(
                F.sum("n").cast("double").alias("value")
            )
        )
        decoded = per_label.select(decode_label("PotentialFraud").alias("flag"), "n")
        yes = F.sum(F.when(F.col("flag"), F.col("n")).otherwise(0))
        known = F.sum(F.when(F.col("flag").isNotNull(), F.col("n")))
        parts.append(
            decoded.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                scaled_ratio(yes * 100, known, 2).alias("rate"),
            ).select(
                F.inline(
                    F.array(
                        _metric("provider_count", F.col("rows")),
                        _metric("fraud_rate_pct", from_units(F.col("rate"))),
                    )
                )
            )
        )
    for table, name in [
        ("beneficiary", "beneficiary_count"),
        ("inpatient", "inpatient_claims_count"),
        ("outpatient", "outpatient_claims_count"),
    ]:
        if table in tables:
            parts.append(
                tables[table].agg(F.count("*").alias("n")).select(F.inline(F.array(_metric(name, F.col("n")))))
            )
    return _union(parts)


def _metric(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))


# Declared CHECK conditions as (column, rule, test for a violation).
def _checks(table: str) -> list[tuple[str, str, Column]]:
    def outside(column: str, allowed: list) -> Column:
        return ~F.col(column).isin(allowed)

    if table == "dim_providers":
        return [("fraud_label", "check_domain", outside("fraud_label", ["Yes", "No"]))]
    if table == "dim_beneficiaries":
        return [("gender", "check_domain", outside("gender", [1, 2]))]
    checks = [
        (column, "check_not_negative", F.col(column) < 0)
        for column in ["reimbursed_amount", "deductible_amount"]
    ]
    if table == "fact_inpatient_claims":
        checks.append(("length_of_stay", "check_not_negative", F.col("length_of_stay") < 0))
    if table == "fact_claims_unified":
        checks.append(("claim_type", "check_domain", outside("claim_type", ["Inpatient", "Outpatient"])))
    return checks


def constraint_audit(star: dict[str, DataFrame]) -> DataFrame:
    """(table, column, rule, violations): NOT NULL, CHECK and text lengths."""
    parts = []
    for table, df in star.items():
        rules = [(name, "not_null", F.col(name).isNull()) for name in NOT_NULL[table]]
        rules += _checks(table)
        rules += [
            (name, "max_length", F.length(name) > limit) for name, limit in MAX_LENGTHS[table].items()
        ]
        counts = df.agg(*[F.count_if(test).alias(f"v{i}") for i, (_, _, test) in enumerate(rules)])
        rows = [
            F.struct(
                F.lit(table).alias("table"),
                F.lit(column).alias("column"),
                F.lit(rule).alias("rule"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, (column, rule, _) in enumerate(rules)
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return _union(parts)


def primary_key_audit(star: dict[str, DataFrame]) -> DataFrame:
    """(table, key, duplicate_keys, surplus_rows) of each table's primary key."""
    parts = []
    for table, df in star.items():
        key = PRIMARY_KEYS[table]
        per_key = df.groupBy(key).agg(F.count("*").alias("n"))
        parts.append(
            per_key.agg(
                F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
            ).select(F.lit(table).alias("table"), F.lit(key).alias("key"), "duplicate_keys", "surplus_rows")
        )
    return _union(parts)


def foreign_key_audit(
    facts: dict[str, DataFrame], providers: DataFrame, beneficiaries: DataFrame
) -> DataFrame:
    """(table, column, violations): fact rows whose key has no dimension row."""
    keys = {"provider_id": providers, "bene_id": beneficiaries}
    tables = [name for name in FACTS if name in facts]

    def both(df: DataFrame) -> DataFrame:
        return df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).alias("key")) for k in keys])))

    # One scan of each fact; a key goes on as one row per task, and one join looks up all.
    used = _union([both(facts[t]).withColumn("table", F.lit(t)) for t in tables])
    used = used.groupBy("table", "column", "key").agg(F.count("*").alias("n")).where(F.col("key").isNotNull())
    known = _union([dim.select(F.lit(k).alias("column"), F.col(k).alias("key")) for k, dim in keys.items()])
    orphans = used.join(known, ["column", "key"], "left_anti").groupBy("table", "column").agg(F.sum("n").alias("n"))
    every = F.array(*[F.struct(F.lit(t).alias("table"), F.lit(k).alias("column")) for t in tables for k in keys])
    return providers.sparkSession.range(1).select(F.inline(every)).join(orphans, ["table", "column"], "left").select(
        "table", "column", F.coalesce("n", F.lit(0)).alias("violations")
    )


def star_audit(star: dict[str, DataFrame]) -> DataFrame:
    """(table, column, rule, violations) of all declared constraints, keys and references."""
    keys = primary_key_audit(star).select("table", F.col("key").alias("column"), F.lit("primary_key").alias("rule"), F.col("surplus_rows").alias("violations"))
    references = foreign_key_audit(star, star["dim_providers"], star["dim_beneficiaries"])
    return constraint_audit(star).select("table", "column", "rule", "violations").unionByName(keys).unionByName(
        references.select("table", "column", F.lit("foreign_key").alias("rule"), "violations")
    )


def enforce_star(report: DataFrame) -> DataFrame:
    """Raise when a stored table breaks a constraint; the report is complete by then."""
    failed = report.where("violations > 0").orderBy("table", "column", "rule").collect()
    if failed:
        raise DataQualityError("; ".join(f"{r['table']}.{r['column']}: {r['rule']} ({r['violations']})" for r in failed))
    return report
