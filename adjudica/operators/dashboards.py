"""Datasets behind the dashboard visuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.money import as_money, from_units, scaled_ratio, sum_cents
from adjudica.operators.analytics import same_day_groups, state_totals
from adjudica.operators.ranking import running_totals
from adjudica.operators.star import Star

LONG_STAY_DAYS = 15

# Conditions compared between flagged and other providers.
COMPARED_CONDITIONS = [
    "chronic_alzheimer", "chronic_heartfailure", "chronic_kidneydisease", "chronic_diabetes",
]

# Columns of the risk queue and of the claim audit list.
QUEUE_COLUMNS = [
    "provider_id", "risk_tier", "fraud_risk_probability", "total_reimbursed",
    "claims_per_beneficiary", "same_day_duplicate_claims",
]
AUDIT_COLUMNS = [
    "claim_id", "claim_type", "claim_start_date", "reimbursed_amount", "deductible_amount",
    "length_of_stay", "attending_physician", "primary_diagnosis_code",
]


def claim_type_mix(star: Star) -> DataFrame:
    """G1: share of volume and of money by claim type (one row per type)."""
    types = star["fact_claims_unified"].groupBy("claim_type").agg(
        F.count("*").alias("claims"), sum_cents("reimbursed_amount").alias("paid")
    )
    everything = Window.partitionBy()
    return types.select(
        "claim_type", "claims", as_money(F.col("paid")).alias("total_reimbursement"),
        from_units(scaled_ratio(F.col("claims") * 100, F.sum("claims").over(everything), 2)).alias("claim_share_pct"),
        (F.col("paid") / F.sum("paid").over(everything) * 100).alias("money_share_pct"),
    )


def flagged_states(star: Star, k: int = 10) -> DataFrame:
    """G2: states by the money paid to flagged providers."""
    flagged = F.col("potential_fraud")
    return (
        state_totals(star)
        .groupBy("state_id")
        .agg(
            F.sum(F.when(flagged, F.col("paid")).otherwise(0)).alias("exposed"),
            F.sum(F.when(flagged, F.col("n")).otherwise(0)).alias("flagged_claims"),
            F.sum("n").alias("total_claims"),
        )
        .orderBy(F.desc("exposed"), "state_id")
        .limit(k)
        .select("state_id", as_money(F.col("exposed")).alias("fraud_exposure"), "flagged_claims", "total_claims")
    )


def _median(df: DataFrame, column: str) -> Column:
    """Exact median of a provider-grain column as a one-value subquery.

    Equal values are counted, then numbered in range-partitioned slices.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    placed = running_totals(counts, [F.asc("v")], {"upto": F.col("n")})
    total = placed.agg(F.sum("n")).scalar()
    located = placed.withColumn("t", total)
    low, high = F.expr("(t + 1) div 2"), F.expr("t div 2 + 1")

    def holds(rank: Column) -> Column:
        return (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)

    return located.agg(
        (F.max(F.when(holds(low), F.col("v"))) + F.max(F.when(holds(high), F.col("v")))) / 2.0
    ).scalar()


def provider_quadrant(scores: DataFrame) -> DataFrame:
    """G3: scatter data; the quadrant is cut at the medians of both axes."""
    cuts = scores.withColumn("_cut_claims", _median(scores, "total_claims")).withColumn(
        "_cut_paid", _median(scores, "mean_reimbursed")
    )
    busy = F.when(F.col("total_claims") > F.col("_cut_claims"), "high volume").otherwise("low volume")
    costly = F.when(F.col("mean_reimbursed") > F.col("_cut_paid"), "high payout").otherwise("low payout")
    return cuts.select(
        "provider_id",
        F.log10("total_claims").alias("log_claims"),
        "mean_reimbursed", "total_reimbursed", "risk_tier",
        F.concat_ws(", ", busy, costly).alias("quadrant"),
    )


def risk_queue(scores: DataFrame, k: int = 20) -> DataFrame:
    """G4: providers by probability."""
    return scores.select(*QUEUE_COLUMNS).orderBy(F.desc("fraud_risk_probability"), "provider_id").limit(k)


def filter_providers(
    scores: DataFrame,
    star: Star,
    tiers: list[str] | None = None,
    states: list[int] | None = None,
    min_claims: int = 0,
) -> DataFrame:
    """G5: dashboard filters; a provider is in a state when a patient of it is."""
    kept = scores.where(F.col("total_claims") >= min_claims)
    if tiers:
        kept = kept.where(F.col("risk_tier").isin(tiers))
    if states:
        patients = star["dim_beneficiaries"].where(F.col("state_id").isin(states)).select("bene_id")
        pairs = star["fact_claims_unified"].select("provider_id", "bene_id").distinct()
        present = pairs.join(patients, "bene_id", "left_semi").select("provider_id").distinct()
        kept = kept.join(present, "provider_id", "left_semi")
    return kept.select(*scores.columns)


def condition_prevalence(star: Star) -> DataFrame:
    """G6: share of claims whose patient has the condition, by fraud label."""
    flags = star["dim_beneficiaries"].select(
        "bene_id", *[F.col(name).cast("int").alias(name) for name in COMPARED_CONDITIONS]
    )
    # Added up per provider before the provider join.
    per_provider = (
        star["fact_claims_unified"]
        .groupBy("provider_id", "bene_id")
        .agg(F.count("*").alias("n"), sum_cents("reimbursed_amount").alias("paid"))
        .join(flags, "bene_id")
        .groupBy("provider_id")
        .agg(
            F.sum("n").alias("n"), F.sum("paid").alias("paid"),
            *[F.sum(F.col(name) * F.col("n")).alias(name) for name in COMPARED_CONDITIONS],
        )
    )
    labelled = per_provider.join(star["dim_providers"].select("provider_id", "fraud_label"), "provider_id")
    sums = labelled.groupBy("fraud_label").agg(
        F.sum("n").alias("claims"), F.sum("paid").alias("paid"), *[F.sum(name).alias(name) for name in COMPARED_CONDITIONS]
    )
    return sums.select(
        "fraud_label", "claims", as_money(F.col("paid")).alias("total_reimbursement"),
        *[(F.col(name) / F.col("claims")).alias(f"{name}_share") for name in COMPARED_CONDITIONS],
    )


def _stays(star: Star) -> DataFrame:
    """Inpatient stays counted per length in days."""
    return (
        star["fact_inpatient_claims"]
        .where(F.col("length_of_stay").isNotNull())
        .groupBy("length_of_stay")
        .agg(F.count("*").alias("n"))
    )


def stay_histogram(star: Star) -> DataFrame:
    """G7: inpatient claims per length of stay, long stays flagged."""
    return _stays(star).select(
        "length_of_stay", F.col("n").alias("claims"), (F.col("length_of_stay") > LONG_STAY_DAYS).alias("long_stay")
    )


def stay_quartiles(star: Star) -> DataFrame:
    """G7: box-plot figures, computed on the counted lengths."""
    quartiles = F.expr("percentile(length_of_stay, array(0.25, 0.5, 0.75), n)")
    return (
        _stays(star)
        .agg(
            F.min("length_of_stay").alias("shortest"),
            quartiles.alias("q"),
            F.max("length_of_stay").alias("longest"),
            F.sum(F.when(F.col("length_of_stay") > LONG_STAY_DAYS, F.col("n")).otherwise(0)).alias("long_stays"),
        )
        .select(
            "shortest", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q2"), F.col("q")[2].alias("q3"),
            "longest", "long_stays",
        )
    )


def same_day_distribution(star: Star) -> DataFrame:
    """G8: how many same-day groups have each size."""
    return (
        same_day_groups(star["fact_claims_unified"])
        .groupBy(F.col("n").alias("claims_per_day"))
        .agg(F.count("*").alias("groups"))
    )


def claim_audit(star: Star, provider_id: str) -> DataFrame:
    """G9: all claims of one provider; the filter reaches the Parquet scan."""
    return star["fact_claims_unified"].where(F.col("provider_id") == provider_id).select(*AUDIT_COLUMNS)


def physician_network(star: Star, provider_id: str | None = None) -> DataFrame:
    """G10: claims and share by attending physician within each provider."""
    claims = star["fact_claims_unified"].where(F.col("attending_physician").isNotNull())
    if provider_id is not None:
        claims = claims.where(F.col("provider_id") == provider_id)
    counts = claims.groupBy("provider_id", "attending_physician").agg(F.count("*").alias("claims"))
    whole = counts.groupBy("provider_id").agg(F.sum("claims").alias("_all"))
    return counts.join(whole, "provider_id").select(
        "provider_id", "attending_physician", "claims",
        (F.col("claims") / F.col("_all")).alias("share_of_provider"),
    )
