"""The eighteen analytical queries over the star schema.

Facts meet large dimensions only after they were added up per provider and
beneficiary, so a key that holds a third of all claims reaches a join as a
few added-up rows. Top-k queries sort the narrow fact first and join the few
remaining rows to the dimensions, which is exact because the star keeps only
claims whose keys exist and those keys are unique. States alone are looked up claim
by claim (``state_totals``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.money import as_money, avg_money, cents, divide_half_up, from_units, scaled_ratio, sum_cents
from adjudica.operators.ranking import global_row_number, ntile_bucket
from adjudica.operators.star import Star

# States of the within-state ranking.
RANKED_STATES = [1, 5, 10, 33]

# Conditions added up by the comorbidity query (8 of the 11).
COMORBIDITY_FLAGS = [
    "chronic_alzheimer", "chronic_heartfailure", "chronic_kidneydisease", "chronic_cancer",
    "chronic_copd", "chronic_depression", "chronic_diabetes", "chronic_stroke",
]


def claim_month():
    return F.date_format("claim_start_date", "yyyy-MM")


def claims_by_pair(claims: DataFrame) -> DataFrame:
    """Claims added up per (provider, beneficiary)."""
    return claims.groupBy("provider_id", "bene_id").agg(
        F.count("*").alias("n"), sum_cents("reimbursed_amount").alias("paid")
    )


def provider_totals(claims: DataFrame) -> DataFrame:
    return claims.groupBy("provider_id").agg(
        F.count("*").alias("n"), sum_cents("reimbursed_amount").alias("paid")
    )


def state_totals(star: Star) -> DataFrame:
    """Claims added up per (state, provider, flag).

    Three narrow columns of a claim meet the states, so against a large dimension they are
    sent once, and the adaptive skew join splits a hot beneficiary; pairs would be sent twice.
    """
    claims = star["fact_claims_unified"].select("provider_id", "bene_id", "reimbursed_amount")
    return (
        claims.join(star["dim_beneficiaries"].select("bene_id", "state_id"), "bene_id")
        .groupBy("state_id", "provider_id")
        .agg(F.count("*").alias("n"), sum_cents("reimbursed_amount").alias("paid"))
        .join(star["dim_providers"], "provider_id")
    )


def portfolio_kpi(star: Star) -> DataFrame:
    """Q1: size and money of the whole portfolio."""
    totals = star["fact_claims_unified"].agg(
        F.count("*").alias("n"),
        F.count_distinct("bene_id").alias("benes"),
        F.count_distinct("provider_id").alias("providers"),
        sum_cents("reimbursed_amount").alias("paid"),
        sum_cents("deductible_amount").alias("deducted"),
    )
    return totals.select(
        F.col("n").alias("total_claims"),
        F.col("benes").alias("distinct_beneficiaries"),
        F.col("providers").alias("active_providers"),
        as_money(F.col("paid")).alias("total_reimbursement_usd"),
        avg_money(F.col("paid"), F.col("n")).alias("avg_reimbursement_usd"),
        as_money(F.col("deducted")).alias("total_deductible_usd"),
    )


def claim_type_breakdown(star: Star) -> DataFrame:
    """Q2: money and stay by claim type."""
    n = F.col("claim_count")
    return (
        star["fact_claims_unified"]
        .groupBy("claim_type")
        .agg(
            F.count("*").alias("claim_count"),
            sum_cents("reimbursed_amount").alias("paid"),
            sum_cents("deductible_amount").alias("deducted"),
            F.sum("length_of_stay").alias("days"),
        )
        .select(
            "claim_type",
            "claim_count",
            as_money(F.col("paid")).alias("total_reimbursed"),
            avg_money(F.col("paid"), n).alias("avg_reimbursed"),
            avg_money(F.col("deducted"), n).alias("avg_deductible"),
            from_units(scaled_ratio(F.col("days"), n, 1), 1).alias("avg_length_of_stay_days"),
        )
    )


def heavy_providers(star: Star, min_claims: int = 100, min_average: int = 1500, k: int = 15) -> DataFrame:
    """Q3: busy providers with a high average payout, by payout."""
    totals = provider_totals(star["fact_claims_unified"]).where(
        (F.col("n") >= min_claims) & (F.col("paid") > F.col("n") * (min_average * 100))
    )
    return (
        totals.join(star["dim_providers"], "provider_id")
        .orderBy(F.desc("paid"), "provider_id")
        .limit(k)
        .select(
            "provider_id",
            "fraud_label",
            F.col("n").alias("claim_count"),
            as_money(F.col("paid")).alias("total_payout"),
            avg_money(F.col("paid"), F.col("n")).alias("avg_payout_per_claim"),
        )
    )


def monthly_trend(star: Star) -> DataFrame:
    """Q4: volume and money by month, ascending."""
    return (
        star["fact_claims_unified"]
        .groupBy(claim_month().alias("claim_year_month"))
        .agg(F.count("*").alias("monthly_claims"), sum_cents("reimbursed_amount").alias("paid"))
        .orderBy(F.asc_nulls_last("claim_year_month"))
        .select(
            "claim_year_month",
            "monthly_claims",
            as_money(F.col("paid")).alias("monthly_reimbursed_usd"),
            avg_money(F.col("paid"), F.col("monthly_claims")).alias("avg_claim_cost"),
        )
    )


def state_breakdown(star: Star, k: int = 10) -> DataFrame:
    """Q5: busiest states with the share of claims from flagged providers."""
    flagged = F.when(F.col("potential_fraud"), F.col("n")).otherwise(F.lit(0))
    return (
        state_totals(star)
        .groupBy("state_id")
        .agg(
            F.sum("n").alias("total_claims"),
            # One row per state and provider, so counting rows counts providers.
            F.count("provider_id").alias("providers_operating"),
            F.sum("paid").alias("paid"),
            F.sum(flagged).alias("flagged"),
        )
        .orderBy(F.desc("total_claims"), "state_id")
        .limit(k)
        .select(
            F.col("state_id").cast("bigint").alias("state_id"),
            "total_claims",
            "providers_operating",
            as_money(F.col("paid")).alias("total_reimbursement"),
            from_units(scaled_ratio(F.col("flagged") * 100, F.col("total_claims"), 2)).alias(
                "fraud_claim_percentage"
            ),
        )
    )


def largest_claims(star: Star, above: int = 5000, k: int = 20) -> DataFrame:
    """Q6: largest claims with provider label and patient demographics."""
    top = (
        star["fact_claims_unified"]
        .where(F.col("reimbursed_amount") > above)
        .orderBy(F.desc("reimbursed_amount"), "claim_id", "claim_type")
        .limit(k)
    )
    return (
        top.join(star["dim_providers"], "provider_id")
        .join(star["dim_beneficiaries"], "bene_id")
        .select(
            "claim_id", "claim_type", "provider_id", "fraud_label", "bene_id",
            F.col("gender").cast("bigint").alias("gender"),
            F.col("state_id").cast("bigint").alias("state_id"),
            "claim_start_date", "reimbursed_amount",
            F.col("length_of_stay").cast("bigint").alias("length_of_stay"),
        )
        .orderBy(F.desc("reimbursed_amount"), "claim_id", "claim_type")
    )


def comorbidity_by_label(star: Star) -> DataFrame:
    """Q7: conditions per claim and money per claim, by fraud label."""
    burden = sum((F.col(name).cast("int") for name in COMORBIDITY_FLAGS[1:]), F.col(COMORBIDITY_FLAGS[0]).cast("int"))
    profile = star["dim_beneficiaries"].select("bene_id", burden.alias("burden"))
    n = F.col("total_claims")
    return (
        claims_by_pair(star["fact_claims_unified"])
        .join(profile, "bene_id")
        .groupBy("provider_id")
        .agg(
            F.sum("n").alias("n"),
            F.sum("paid").alias("paid"),
            F.sum(F.when(F.col("burden").isNotNull(), F.col("n"))).alias("with_burden"),
            F.sum(F.col("burden") * F.col("n")).alias("burden"),
        )
        .join(star["dim_providers"], "provider_id")
        .groupBy("fraud_label")
        .agg(
            F.sum("n").alias("total_claims"),
            F.sum("paid").alias("paid"),
            F.sum("with_burden").alias("with_burden"),
            F.sum("burden").alias("burden"),
        )
        .select(
            "fraud_label",
            from_units(scaled_ratio(F.col("burden"), F.col("with_burden"), 2)).alias(
                "avg_patient_chronic_conditions"
            ),
            avg_money(F.col("paid"), n).alias("avg_reimbursement"),
            "total_claims",
        )
    )


def orphan_claims(claims: DataFrame, providers: DataFrame, beneficiaries: DataFrame) -> DataFrame:
    """Q8: claims whose provider or beneficiary is missing.

    ``claims`` are the staged ones, one for each id, or all that the load reads, which
    also finds an orphan that shares its id with a sound claim. They are read once; both
    lookups are outer joins whose strategy Catalyst takes from the dimensions' sizes, and
    AQE splits a hot key. Equal rows are one.
    """
    found = claims.select("claim_id", "provider_id", "bene_id")
    for key, known in (("provider_id", providers), ("bene_id", beneficiaries)):
        found = found.join(known.select(key, F.lit(True).alias(f"_{key}")), key, "left")
    missing = F.col("_provider_id").isNull() | F.col("_bene_id").isNull()
    return found.where(missing).select("claim_id", "provider_id", "bene_id").distinct()


def long_stay_providers(star: Star, min_claims: int = 10, factor: int = 2, k: int = 15) -> DataFrame:
    """Q9: providers whose average stay exceeds a multiple of the state average.

    Both averages are compared after rounding to hundredths of a day.
    """
    by_pair = star["fact_inpatient_claims"].groupBy("provider_id", "bene_id").agg(
        F.count("*").alias("n"),
        F.count("length_of_stay").alias("stays"),
        F.sum("length_of_stay").alias("days"),
    )
    by_provider = (
        by_pair.join(star["dim_beneficiaries"].select("bene_id", "state_id"), "bene_id")
        .groupBy("provider_id", "state_id")
        .agg(F.sum("n").alias("n"), F.sum("stays").alias("stays"), F.sum("days").alias("days"))
    )
    by_state = by_provider.groupBy("state_id").agg(
        scaled_ratio(F.sum("days"), F.sum("stays"), 2).alias("state_los")
    )
    return (
        by_provider.where(F.col("n") >= min_claims)
        .withColumn("prov_los", scaled_ratio(F.col("days"), F.col("stays"), 2))
        .join(by_state, "state_id")
        .where(F.col("prov_los") > F.col("state_los") * factor)
        .orderBy(F.desc("prov_los"), "provider_id", "state_id")
        .limit(k)
        .select(
            "provider_id",
            F.col("state_id").cast("bigint").alias("state_id"),
            from_units(F.col("prov_los")).alias("avg_prov_los"),
            from_units(F.col("state_los")).alias("avg_state_los"),
        )
    )


def state_payout_ranks(star: Star, states: list[int] | None = None, k: int = 20) -> DataFrame:
    """Q10: dense rank of providers by payout inside each state.

    A row's rank depends only on rows before it in the output order, so the
    first ``k`` rows are taken first and ranked afterwards.
    """
    wanted = star["dim_beneficiaries"].where(F.col("state_id").isin(states or RANKED_STATES))
    first = (
        state_totals({**star, "dim_beneficiaries": wanted})
        .orderBy("state_id", F.desc("paid"), "provider_id")
        .limit(k)
    )
    rank = F.dense_rank().over(Window.partitionBy("state_id").orderBy(F.desc("paid")))
    return first.select(
        F.col("state_id").cast("bigint").alias("state_id"),
        "provider_id",
        "fraud_label",
        as_money(F.col("paid")).alias("total_state_reimbursement"),
        rank.cast("bigint").alias("state_payout_rank"),
    ).orderBy("state_id", "state_payout_rank", "provider_id")


def cumulative_payout(star: Star) -> DataFrame:
    """Q11: monthly payout and its running total; one row per month."""
    months = (
        star["fact_claims_unified"]
        .groupBy(claim_month().alias("claim_month"))
        .agg(sum_cents("reimbursed_amount").alias("paid"))
    )
    so_far = Window.orderBy(F.asc_nulls_last("claim_month")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return months.select(
        "claim_month",
        as_money(F.col("paid")).alias("monthly_payout"),
        as_money(F.sum("paid").over(so_far)).alias("cumulative_payout_ytd"),
    ).orderBy(F.asc_nulls_last("claim_month"))


def top_payout_deciles(star: Star, k: int = 20, buckets: int = 10) -> DataFrame:
    """Q12: payout decile of the ``k`` best paid providers.

    The decile follows from the row number and the provider count, so only the
    reported rows are numbered.
    """
    totals = provider_totals(star["fact_claims_unified"])
    providers = totals.agg(F.count("*")).scalar()
    order = [F.desc("paid"), F.asc("provider_id")]
    top = totals.orderBy(*order).limit(k)
    number = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return (
        top.withColumn("_row", number)
        .withColumn("_providers", providers)
        .select(
            "provider_id",
            F.col("n").alias("total_claims"),
            as_money(F.col("paid")).alias("total_reimbursement"),
            ntile_bucket(F.col("_row"), F.col("_providers"), buckets).alias("payout_decile"),
        )
        .orderBy(F.desc("total_reimbursement"), "provider_id")
    )


def payout_deciles(star: Star, buckets: int = 10) -> DataFrame:
    """Payout decile of every provider."""
    totals = provider_totals(star["fact_claims_unified"])
    count = totals.agg(F.count("*")).scalar()
    numbered = global_row_number(totals, [F.desc("paid"), F.asc_nulls_last("provider_id")], "_row")
    return numbered.withColumn("_providers", count).select(
        "provider_id",
        F.col("n").alias("total_claims"),
        as_money(F.col("paid")).alias("total_reimbursement"),
        ntile_bucket(F.col("_row"), F.col("_providers"), buckets).alias("payout_decile"),
    )


def rolling_claim_average(star: Star, providers: int = 3, width: int = 3, k: int = 25) -> DataFrame:
    """Q13: moving average over the claims of the first flagged providers.

    The frame only looks back, so the first ``k`` rows of the output order
    hold everything their averages need.
    """
    chosen = star["dim_providers"].where("potential_fraud").orderBy("provider_id").limit(providers)
    order = ["provider_id", "claim_start_date", "claim_id"]
    sort = [F.asc_nulls_last(name) for name in order]
    first = (
        star["fact_claims_unified"]
        .join(F.broadcast(chosen.select("provider_id")), "provider_id", "left_semi")
        .select(*order, "reimbursed_amount")
        .orderBy(*sort)
        .limit(k)
    )
    frame = Window.partitionBy("provider_id").orderBy(*sort[1:]).rowsBetween(1 - width, 0)
    paid = cents(F.col("reimbursed_amount"))
    rolling = as_money(divide_half_up(F.sum(paid).over(frame), F.count(paid).over(frame)))
    return first.select(
        "claim_id", "provider_id", "claim_start_date", "reimbursed_amount",
        rolling.alias("rolling_3claim_avg_amount"),
    ).orderBy(*sort)


def same_day_groups(claims: DataFrame) -> DataFrame:
    """Claims added up per (provider, beneficiary, start date)."""
    return claims.groupBy("provider_id", "bene_id", "claim_start_date").agg(
        F.count("claim_id").alias("n"), sum_cents("reimbursed_amount").alias("paid")
    )


def same_day_billing(star: Star, k: int = 15) -> DataFrame:
    """Q14: a beneficiary billed more than once by a provider on one day."""
    return (
        same_day_groups(star["fact_claims_unified"])
        .where("n > 1")
        .orderBy(F.desc("n"), F.desc("paid"), "provider_id", "bene_id", "claim_start_date")
        .limit(k)
        .select(
            "provider_id", "bene_id", "claim_start_date",
            F.col("n").alias("same_day_claim_count"),
            as_money(F.col("paid")).alias("total_same_day_payout"),
        )
    )


def stay_outliers(star: Star, min_days: int = 15, k: int = 15) -> DataFrame:
    """Q15: long inpatient stays with the payout per day."""
    top = (
        star["fact_inpatient_claims"]
        .where(F.col("length_of_stay") >= min_days)
        .orderBy(F.desc("reimbursed_amount"), "claim_id")
        .limit(k)
    )
    per_day = as_money(divide_half_up(cents(F.col("reimbursed_amount")), F.col("length_of_stay").cast("bigint")))
    return (
        top.join(star["dim_providers"], "provider_id")
        .select(
            "claim_id", "provider_id", "fraud_label",
            F.col("length_of_stay").cast("bigint").alias("length_of_stay"),
            "reimbursed_amount",
            per_day.alias("reimbursement_per_day"),
            "admit_diagnosis_code",
        )
        .orderBy(F.desc("reimbursed_amount"), "claim_id")
    )


def physician_churn(star: Star, min_claims: int = 50, k: int = 15) -> DataFrame:
    """Q16: attending physicians per claim for busy providers."""
    claims = star["fact_claims_unified"]
    # A claim id is a key of the fact; only physicians need to be made distinct.
    counts = (
        claims.groupBy("provider_id", "attending_physician")
        .agg(F.count("claim_id").alias("n"))
        .groupBy("provider_id")
        .agg(F.sum("n").alias("claims"), F.count("attending_physician").alias("physicians"))
        .where(F.col("claims") >= min_claims)
        .withColumn("ratio", scaled_ratio(F.col("physicians"), F.col("claims"), 3))
    )
    return (
        counts.join(star["dim_providers"], "provider_id")
        .orderBy(F.desc("ratio"), "provider_id")
        .limit(k)
        .select(
            "provider_id", "fraud_label",
            F.col("claims").alias("total_claims"),
            F.col("physicians").alias("distinct_physicians"),
            from_units(F.col("ratio"), 3).alias("physician_to_claim_ratio"),
        )
    )


def costly_diagnoses(star: Star, k: int = 10) -> DataFrame:
    """Q17: diagnosis codes by money."""
    return (
        star["fact_claims_unified"]
        .where(F.col("primary_diagnosis_code").isNotNull())
        .groupBy("primary_diagnosis_code")
        .agg(F.count("*").alias("n"), sum_cents("reimbursed_amount").alias("paid"))
        .orderBy(F.desc("paid"), "primary_diagnosis_code")
        .limit(k)
        .select(
            "primary_diagnosis_code",
            F.col("n").alias("diagnosis_occurrences"),
            as_money(F.col("paid")).alias("total_amount"),
            avg_money(F.col("paid"), F.col("n")).alias("avg_claim_cost"),
        )
    )


def high_value_providers(star: Star, above: int = 2000, k: int = 10) -> DataFrame:
    """Q18: providers by the money of their claims above an amount."""
    return (
        provider_totals(star["fact_claims_unified"].where(F.col("reimbursed_amount") > above))
        .orderBy(F.desc("paid"), "provider_id")
        .limit(k)
        .select(
            "provider_id",
            F.col("n").alias("claim_count"),
            as_money(F.col("paid")).alias("total_reimbursed"),
        )
    )


ANALYTICS = {
    "q01_portfolio_kpi": portfolio_kpi,
    "q02_claim_type_breakdown": claim_type_breakdown,
    "q03_heavy_providers": heavy_providers,
    "q04_monthly_trend": monthly_trend,
    "q05_state_breakdown": state_breakdown,
    "q06_largest_claims": largest_claims,
    "q07_comorbidity_by_label": comorbidity_by_label,
    "q09_long_stay_providers": long_stay_providers,
    "q10_state_payout_ranks": state_payout_ranks,
    "q11_cumulative_payout": cumulative_payout,
    "q12_payout_deciles": top_payout_deciles,
    "q13_rolling_claim_average": rolling_claim_average,
    "q14_same_day_billing": same_day_billing,
    "q15_stay_outliers": stay_outliers,
    "q16_physician_churn": physician_churn,
    "q17_costly_diagnoses": costly_diagnoses,
    "q18_high_value_providers": high_value_providers,
}
