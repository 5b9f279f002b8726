"""The five reporting tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.money import as_money, avg_money, cents, from_units, scaled_ratio, sum_cents
from adjudica.operators.analytics import portfolio_kpi, state_totals
from adjudica.operators.star import Star

# Cuts, tier names and size of the drill-through extract.
DEFAULT_THRESHOLD = 0.5
MEDIUM_FLOOR = 0.30
HIGH, MEDIUM, LOW = "High Risk", "Medium Risk", "Low Risk"
DRILL_ROWS = 15_000


def risk_tier(probability: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return (
        F.when(probability >= threshold, HIGH)
        .when((probability >= MEDIUM_FLOOR) & (probability < threshold), MEDIUM)
        .otherwise(LOW)
    )


def provider_risk_scores(
    features: DataFrame, scores: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Features with probability (4 decimals), prediction and tier.

    ``scores`` is (provider_id, probability); prediction and tier use the
    unrounded probability.
    """
    p = F.col("probability")
    joined = features.join(scores.select("provider_id", "probability"), "provider_id")
    return joined.select(
        *features.columns,
        F.bround(p, 4).alias("fraud_risk_probability"),
        (p >= threshold).cast("bigint").alias("model_fraud_prediction"),
        risk_tier(p, threshold).alias("risk_tier"),
    )


def kpi_summary(star: Star, features: DataFrame) -> DataFrame:
    """One row of portfolio figures."""
    flagged = F.col("potential_fraud")
    exposed = F.round(F.col("total_reimbursed") * 100).cast("bigint")
    providers = features.agg(
        F.struct(
            F.count_if(flagged).alias("flagged"),
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.when(flagged, exposed)), F.lit(0)).alias("exposed"),
        ).alias("p")
    ).scalar()
    kpi = portfolio_kpi(star).withColumn("_p", providers)
    total = cents(F.col("total_reimbursement_usd"))
    return kpi.select(
        "total_claims",
        "distinct_beneficiaries",
        F.col("active_providers").alias("total_providers"),
        F.col("_p.flagged").alias("fraudulent_providers_count"),
        from_units(scaled_ratio(F.col("_p.flagged") * 100, F.col("_p.n"), 2)).alias(
            "portfolio_fraud_provider_rate_pct"
        ),
        "total_reimbursement_usd",
        as_money(F.col("_p.exposed")).alias("total_fraud_loss_exposure_usd"),
        from_units(_share_pct(F.col("_p.exposed"), total)).alias("fraud_financial_share_pct"),
        F.col("avg_reimbursement_usd").alias("avg_reimbursement_per_claim_usd"),
        "total_deductible_usd",
    )


def _share_pct(part: Column, whole: Column) -> Column:
    """Percent with two decimals as hundredths; decimals keep large sums exact."""
    ratio = F.try_divide(part.cast("decimal(25,0)") * 10000, whole.cast("decimal(25,0)"))
    return F.round(ratio, 0).cast("bigint")


def temporal_trends(star: Star) -> DataFrame:
    """Volume, money, active providers and patients by month.

    The (month, key) pairs of each kind are deduplicated apart, before and after
    the shuffle, so a heavy month is spread over its providers and patients and
    no pair carries the sums. Then a month has one row of each kind.
    """
    claims = star["fact_claims_unified"].withColumn("_month", F.trunc("claim_start_date", "month"))
    totals = claims.groupBy("_month").agg(
        F.count("*").alias("total_claims"),
        F.count_if(F.col("claim_type") == "Inpatient").alias("inpatient_claims"),
        F.count_if(F.col("claim_type") == "Outpatient").alias("outpatient_claims"),
        sum_cents("reimbursed_amount").alias("paid"),
    )

    def counted(key: str, name: str) -> DataFrame:
        pairs = claims.select("_month", key).where(F.col(key).isNotNull()).distinct()
        return pairs.groupBy("_month").agg(F.count("*").alias(name))

    found = totals
    for key, name in (("provider_id", "active_providers"), ("bene_id", "distinct_beneficiaries")):
        found = found.unionByName(counted(key, name), allowMissingColumns=True)
    counts = [c for c in found.columns if c not in ("_month", "paid")]
    return (
        found.groupBy("_month")
        .agg(F.sum("paid").alias("paid"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
        .withColumn("claim_year_month", F.date_format("_month", "yyyy-MM"))
        .orderBy(F.asc_nulls_last("claim_year_month"))
        .select(
            "claim_year_month", "total_claims", "inpatient_claims", "outpatient_claims",
            as_money(F.col("paid")).alias("total_reimbursement"),
            avg_money(F.col("paid"), F.col("total_claims")).alias("avg_reimbursement"),
            "active_providers", "distinct_beneficiaries",
        )
    )


def state_geographic_summary(star: Star) -> DataFrame:
    """All states, busiest first, with the claims of flagged providers."""
    # Claims are reduced to (state, provider) before the provider join; a patient has one state.
    per_state = (
        star["fact_claims_unified"]
        .select("bene_id")
        .distinct()
        .join(star["dim_beneficiaries"].select("bene_id", "state_id"), "bene_id")
        .groupBy(F.col("state_id").alias("_state"))
        .agg(F.count("*").alias("total_patients"))
    )
    totals = state_totals(star).select("state_id", "provider_id", "n", "paid", "potential_fraud")
    return (
        totals.groupBy("state_id")
        .agg(
            F.sum("n").alias("total_claims"),
            F.count("*").alias("total_providers"),
            F.sum("paid").alias("paid"),
            F.sum(F.when(F.col("potential_fraud"), F.col("n")).otherwise(0)).alias("fraud_claims_count"),
        )
        .join(per_state, F.col("state_id").eqNullSafe(F.col("_state")))
        .orderBy(F.desc("total_claims"), "state_id")
        .select(
            "state_id", "total_claims", "total_patients", "total_providers",
            as_money(F.col("paid")).alias("total_reimbursement"),
            avg_money(F.col("paid"), F.col("total_claims")).alias("avg_reimbursement"),
            "fraud_claims_count",
            from_units(scaled_ratio(F.col("fraud_claims_count") * 100, F.col("total_claims"), 2)).alias(
                "fraud_claim_rate_pct"
            ),
        )
    )


def top_claims(claims: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest claims, ties by claim id.

    A plain sort-and-limit sends ``k`` rows from every scan task to one task.
    Here a count per amount gives the amount that closes the top ``k``; the
    scan then keeps only rows at or above it, dealt out by claim id, and the
    final limit sees ``k`` rows plus the ties of the closing amount at most
    from each of the shuffle's tasks.
    """
    per_amount = claims.groupBy("reimbursed_amount").agg(F.count("*").alias("n"))
    largest = per_amount.where(F.col("reimbursed_amount").isNotNull()).orderBy(F.desc("reimbursed_amount")).limit(k)
    before = Window.orderBy(F.desc("reimbursed_amount")).rowsBetween(Window.unboundedPreceding, -1)
    closing = (
        largest.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where(F.col("_before") < k)
        .agg(F.min("reimbursed_amount"))
        .scalar()
    )
    kept = claims.where(F.col("reimbursed_amount") >= closing).repartition("claim_id")
    return kept.orderBy(F.desc("reimbursed_amount"), "claim_id", "claim_type").limit(k)


def drill_base(star: Star, k: int = DRILL_ROWS) -> DataFrame:
    """Largest claims with label and demographics, before scores are added."""
    claims = star["fact_claims_unified"].select(
        "claim_id", "claim_type", "provider_id", "bene_id", "claim_start_date", "claim_end_date",
        "reimbursed_amount", "deductible_amount", "length_of_stay", "attending_physician",
        "primary_diagnosis_code",
    )
    return (
        top_claims(claims, k)
        .join(star["dim_providers"], "provider_id")
        .join(star["dim_beneficiaries"].select("bene_id", "state_id", "gender"), "bene_id")
        .select(
            "claim_id", "claim_type", "provider_id",
            F.col("fraud_label").alias("ground_truth_fraud"),
            "bene_id", "state_id", "gender", "claim_start_date", "claim_end_date",
            "reimbursed_amount", "deductible_amount", "length_of_stay",
            "attending_physician", "primary_diagnosis_code",
        )
    )


def claims_drillthrough(star: Star, risk_scores: DataFrame, k: int = DRILL_ROWS) -> DataFrame:
    """The ``k`` largest claims with the provider's score and tier."""
    scores = risk_scores.select("provider_id", "fraud_risk_probability", "risk_tier")
    drill = drill_base(star, k)
    return drill.join(scores, "provider_id", "left").select(
        *drill.columns, "fraud_risk_probability", "risk_tier"
    )


def all_marts(
    star: Star, features: DataFrame, scores: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> dict[str, DataFrame]:
    risk = provider_risk_scores(features, scores, threshold)
    return {
        "provider_risk_scores": risk,
        "kpi_summary": kpi_summary(star, features),
        "temporal_trends": temporal_trends(star),
        "state_geographic_summary": state_geographic_summary(star),
        "claims_drillthrough_analytical": claims_drillthrough(star, risk),
    }
