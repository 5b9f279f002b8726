"""Billing behaviour of each provider: 33 features, one row per provider.

Claims are added up in four branches whose shuffle keys are finer than the
provider, so a provider holding a third of all claims is spread over the
cluster until only its added-up rows are left. All branches end hashed on the
provider, which the closing joins reuse.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.money import cents
from adjudica.operators.star import Star
from adjudica.schema import CHRONIC_FLAGS

REFERENCE_YEAR = 2009
MAX_AGE = 115
MEDIAN_BIN = 10_000  # neighbouring values per bin of the exact median
ROWS_PER_TASK = 500_000  # narrow rows, a few hundred MB while a task groups them

# Feature names in model order.
FEATURES = [
    "total_claims", "inpatient_claims", "outpatient_claims", "total_reimbursed",
    "mean_reimbursed", "std_reimbursed", "max_reimbursed", "median_reimbursed",
    "total_deductible", "mean_deductible", "zero_reimbursed_count", "inpatient_ratio",
    "deductible_to_reimbursement_ratio", "zero_reimbursed_ratio", "mean_length_of_stay",
    "max_length_of_stay", "distinct_procedures", "distinct_attending_physicians",
    "distinct_operating_physicians", "distinct_diagnosis_codes", "distinct_beneficiaries",
    "mean_patient_age", "renal_disease_ratio", "mean_chronic_conditions", "alzheimer_ratio",
    "heartfailure_ratio", "kidneydisease_ratio", "diabetes_ratio", "ischemic_heart_ratio",
    "same_day_duplicate_claims", "claims_per_beneficiary", "physician_to_claim_ratio",
    "reimbursement_per_beneficiary",
]

# Columns that would give the label away.
LABEL_DERIVED = [
    "fraud_label", "PotentialFraud", "is_fraud", "fraud_probability", "fraud_score",
    "flagged_by_rules",
]


def _usd(cent_column: Column) -> Column:
    return cent_column.cast("double") / 100


def volume_features(claims: DataFrame) -> DataFrame:
    """Counts and money per provider (all but the median)."""
    paid, deducted = cents(F.col("reimbursed_amount")), cents(F.col("deductible_amount"))
    totals = claims.groupBy("provider_id").agg(
        F.count("claim_id").alias("total_claims"),
        F.count_if(F.col("claim_type") == "Inpatient").alias("inpatient_claims"),
        F.count_if(F.col("claim_type") == "Outpatient").alias("outpatient_claims"),
        F.sum(paid).alias("paid"),
        F.count(paid).alias("paid_n"),
        F.stddev_samp(F.col("reimbursed_amount").cast("double")).alias("std"),
        F.max(paid).alias("max_paid"),
        F.sum(deducted).alias("deducted"),
        F.count(deducted).alias("deducted_n"),
        F.count_if(paid == 0).alias("zero_reimbursed_count"),
    )
    claims_n = F.nullif("total_claims", F.lit(0))
    return totals.select(
        "provider_id", "total_claims", "inpatient_claims", "outpatient_claims",
        _usd(F.coalesce("paid", F.lit(0))).alias("total_reimbursed"),
        (_usd(F.col("paid")) / F.nullif("paid_n", F.lit(0))).alias("mean_reimbursed"),
        F.coalesce("std", F.lit(0.0)).alias("std_reimbursed"),
        _usd(F.col("max_paid")).alias("max_reimbursed"),
        _usd(F.coalesce("deducted", F.lit(0))).alias("total_deductible"),
        (_usd(F.col("deducted")) / F.nullif("deducted_n", F.lit(0))).alias("mean_deductible"),
        "zero_reimbursed_count",
        (F.col("inpatient_claims") / claims_n).alias("inpatient_ratio"),
        (_usd(F.coalesce("deducted", F.lit(0))) / (_usd(F.coalesce("paid", F.lit(0))) + 1.0)).alias(
            "deductible_to_reimbursement_ratio"
        ),
        (F.col("zero_reimbursed_count") / claims_n).alias("zero_reimbursed_ratio"),
    )


def _dealt(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt by keys finer than the provider, in tasks of bounded size.

    Everything grouped by these keys, or by more, then needs no further shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // ROWS_PER_TASK)), *keys)


def _walked(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds the running count ``_upto`` of ``_n`` inside each key."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_upto", F.sum("_n").over(upto))


def exact_median(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, median) of an integer value, exact.

    Rows are dealt once, by key and bin of neighbouring values; equal values and
    then bins are counted where they lie. Bins show which one or two of them hold
    the middle; only the values inside those are put in order. So a key with most
    of the rows is never sorted as a whole: a task walks the bins of a key or
    the at most ``MEDIAN_BIN`` values of a bin.
    """
    # The coalesce keeps the join below from pushing a filter into only one
    # of the two uses, so that both read the same dealt rows. Bins follow from
    # the values and are not sent.
    bin_of = F.coalesce(F.floor(F.col("_value") / MEDIAN_BIN), F.lit(0))
    values = df.select(key, value.alias("_value")).where(F.col("_value").isNotNull() & F.col(key).isNotNull())
    counts = _dealt(values, key, bin_of).withColumn("_bin", bin_of).groupBy(key, "_bin", "_value").agg(F.count("*").alias("_n"))
    low, high = F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1")

    def holds(rank: Column) -> Column:
        return (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)

    bins = _walked(counts.groupBy(key, "_bin").agg(F.sum("_n").alias("_n")), [key], "_bin").withColumn(
        "_total", F.sum("_n").over(Window.partitionBy(key))
    )
    middle = bins.where(holds(low) | holds(high)).select(
        key, "_bin", "_total", (F.col("_upto") - F.col("_n")).alias("_before")
    )
    placed = _walked(counts.join(middle, [key, "_bin"]), [key, "_bin"], "_value").withColumn(
        "_upto", F.col("_upto") + F.col("_before")
    )
    return (
        placed.groupBy(key)
        .agg(
            F.max(F.when(holds(low), F.col("_value"))).alias("_low"),
            F.max(F.when(holds(high), F.col("_value"))).alias("_high"),
        )
        .select(key, ((F.col("_low") + F.col("_high")) / 2.0).alias("median"))
    )


def stay_features(inpatient: DataFrame) -> DataFrame:
    return inpatient.groupBy("provider_id").agg(
        F.avg("length_of_stay").alias("mean_length_of_stay"),
        F.max("length_of_stay").cast("double").alias("max_length_of_stay"),
    )


def diversity_features(claims: DataFrame, inpatient: DataFrame) -> DataFrame:
    """Distinct physicians, diagnoses and procedures per provider.

    The (provider, code) rows of each kind are deduplicated apart, then rows are
    counted: hot providers spread over their codes, and a task holds one kind only.
    """
    kinds = {
        "distinct_attending_physicians": "attending_physician",
        "distinct_operating_physicians": "operating_physician",
        "distinct_diagnosis_codes": "primary_diagnosis_code",
    }

    def counted(df: DataFrame, kind: str, column: str) -> DataFrame:
        codes = df.select("provider_id", F.col(column).alias("code")).where("code IS NOT NULL").distinct()
        # Added up by provider in each task, so that few rows meet the other kinds.
        return codes.groupBy("provider_id").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))

    procedures = "distinct_procedures"
    found = counted(inpatient, procedures, "primary_procedure_code")
    for kind, column in kinds.items():
        found = found.unionByName(counted(claims, kind, column))
    return found.groupBy("provider_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(kind) for kind in [*kinds, procedures]]
    )


def patient_features(claims: DataFrame, beneficiaries: DataFrame) -> DataFrame:
    """Patient mix and same-day billing per provider.

    Claims are dealt by (provider, beneficiary) and shrink there to days, then to
    pairs; only pairs meet the beneficiary table.
    """
    dealt = _dealt(claims.select("provider_id", "bene_id", "claim_start_date"), "provider_id", "bene_id")
    days = dealt.groupBy("provider_id", "bene_id", "claim_start_date").agg(F.count("*").alias("n"))
    repeated = (F.col("n") > 1) & F.col("bene_id").isNotNull() & F.col("claim_start_date").isNotNull()
    pairs = days.groupBy("provider_id", "bene_id").agg(F.sum(F.when(repeated, F.col("n"))).alias("repeats"))
    age = F.lit(REFERENCE_YEAR) - F.year("dob")
    age = F.when(age.isNotNull(), F.least(F.greatest(age, F.lit(0)), F.lit(MAX_AGE)))
    conditions = F.lit(0)
    for name in CHRONIC_FLAGS:
        conditions = conditions + F.coalesce(F.col(name).cast("int"), F.lit(0))
    shares = {
        "renal_disease_ratio": "renal_disease",
        "alzheimer_ratio": "chronic_alzheimer",
        "heartfailure_ratio": "chronic_heartfailure",
        "kidneydisease_ratio": "chronic_kidneydisease",
        "diabetes_ratio": "chronic_diabetes",
        "ischemic_heart_ratio": "chronic_ischemicheart",
    }
    profile = beneficiaries.select(
        "bene_id", age.alias("age"), conditions.alias("conditions"),
        *[F.col(column).cast("int").alias(name) for name, column in shares.items()],
    )
    return (
        pairs.join(profile, "bene_id", "left")
        .groupBy("provider_id")
        .agg(
            F.count("bene_id").alias("distinct_beneficiaries"),
            F.avg("age").alias("mean_patient_age"),
            F.avg(F.coalesce("conditions", F.lit(0))).alias("mean_chronic_conditions"),
            *[F.avg(name).alias(name) for name in shares],
            F.sum("repeats").alias("same_day_duplicate_claims"),
        )
    )


def provider_features(
    star: Star, kept: Callable[[str, DataFrame], DataFrame] = lambda name, part: part
) -> DataFrame:
    """provider_id, potential_fraud and the 33 features in model order.

    Providers without claims keep NULL apart from the four zero-filled columns.
    ``kept`` may write a part, which has one row per provider, and read it back, so
    that the shuffle files of one part are gone when the next one's come.
    """
    claims, inpatient = star["fact_claims_unified"], star["fact_inpatient_claims"]
    medians = exact_median(claims, "provider_id", cents(F.col("reimbursed_amount"))).select(
        "provider_id", (F.col("median") / 100).alias("median_reimbursed")
    )
    joined = star["dim_providers"].select("provider_id", "potential_fraud")
    parts = {
        "volume": volume_features(claims),
        "medians": medians,
        "stays": stay_features(inpatient),
        "diversity": diversity_features(claims, inpatient),
        "patients": patient_features(claims, star["dim_beneficiaries"]),
    }
    for name, part in parts.items():
        joined = joined.join(kept(name, part), "provider_id", "left")
    zero_filled = [
        "mean_length_of_stay", "max_length_of_stay", "distinct_procedures", "same_day_duplicate_claims",
    ]
    benes = F.col("distinct_beneficiaries") + 1e-5
    # A provider with claims but without any code has 0 distinct codes, not NULL.
    no_codes = F.when(F.col("total_claims").isNotNull(), F.lit(0))
    counted = ["distinct_attending_physicians", "distinct_operating_physicians", "distinct_diagnosis_codes"]
    filled = joined.fillna(0, subset=zero_filled).withColumns(
        {name: F.coalesce(name, no_codes) for name in counted}
    )
    derived = filled.withColumns(
        {
            "claims_per_beneficiary": F.col("total_claims") / benes,
            "physician_to_claim_ratio": F.col("distinct_attending_physicians")
            / (F.col("total_claims") + 1e-5),
            "reimbursement_per_beneficiary": F.col("total_reimbursed") / benes,
        }
    )
    return derived.select(
        "provider_id", "potential_fraud", *[F.col(name).cast("double").alias(name) for name in FEATURES]
    )


def assert_no_leakage(features: DataFrame) -> DataFrame:
    leaked = set(features.columns) & set(LABEL_DERIVED)
    if leaked:
        raise ValueError(f"label-derived columns among the features: {sorted(leaked)}")
    return features
