"""The twenty dashboard measures.

``drill`` is any frame of claims in the drill-through shape: all claims, or the
extract of the largest ones if that is passed. ``scores`` the provider risk scores and
``trends`` the monthly trends. ``by`` names grouping columns, so a dashboard
filter is a ``where`` on the argument and a breakdown is a ``by``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.money import as_money, cents, sum_cents
from adjudica.operators.marts import HIGH
from adjudica.operators.ranking import global_row_number
from adjudica.session import checkpointed

# Fraud-rate bands and display colours.
RED_ABOVE, AMBER_FROM = 35, 20
RAG_COLOURS = {"RED": "#E74C3C", "AMBER": "#F39C12", "GREEN": "#2ECC71"}
RAG_DEFAULT = "#BDC3C7"
TIER_COLOURS = {"High Risk": "#D9534F", "Medium Risk": "#F0AD4E", "Low Risk": "#5CB85C"}
TIER_DEFAULT = "#CCCCCC"

# Header text (provider, percent, tier) and what stands in when
# not exactly one provider is selected.
SUMMARY_FORMAT = "Provider %s | Model Probability: %s%% | Tier: %s"
NO_PROVIDER, NO_PROBABILITY, NO_TIER = "None Selected", 0.0, "Unknown"

By = list[str] | None


def _measure(df: DataFrame, name: str, value: Column, by: By = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(value.alias(name))


def _usd(cent_sum: Column) -> Column:
    return as_money(cent_sum)


def _pct(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)) * 100


def _is_fraud() -> Column:
    return F.col("ground_truth_fraud") == "Yes"


def total_claims(drill: DataFrame, by: By = None) -> DataFrame:
    return _measure(drill, "total_claims", F.count("*"), by)


def total_reimbursement(drill: DataFrame, by: By = None) -> DataFrame:
    return _measure(drill, "total_reimbursement", _usd(sum_cents("reimbursed_amount")), by)


def avg_claim_cost(drill: DataFrame, by: By = None) -> DataFrame:
    paid = sum_cents("reimbursed_amount").cast("double") / 100
    return _measure(drill, "avg_claim_cost", F.try_divide(paid, F.count("reimbursed_amount")), by)


def total_deductibles_paid(drill: DataFrame, by: By = None) -> DataFrame:
    return _measure(drill, "total_deductibles_paid", _usd(sum_cents("deductible_amount")), by)


def active_providers(scores: DataFrame, by: By = None) -> DataFrame:
    return _measure(scores, "active_providers", F.count_distinct("provider_id"), by)


def total_beneficiaries(drill: DataFrame, by: By = None) -> DataFrame:
    return _measure(drill, "total_beneficiaries", F.count_distinct("bene_id"), by)


def fraud_claims_count(drill: DataFrame, by: By = None) -> DataFrame:
    return _measure(drill, "fraud_claims_count", F.count_if(_is_fraud()), by)


def portfolio_fraud_rate(drill: DataFrame, by: By = None) -> DataFrame:
    return _measure(drill, "portfolio_fraud_rate_pct", _pct(F.count_if(_is_fraud()), F.count("*")), by)


def predicted_high_risk(scores: DataFrame, by: By = None) -> DataFrame:
    return _measure(scores, "predicted_high_risk_providers", F.count_if(F.col("risk_tier") == HIGH), by)


def high_risk_provider_pct(scores: DataFrame, by: By = None) -> DataFrame:
    share = _pct(F.count_if(F.col("risk_tier") == HIGH), F.count_distinct("provider_id"))
    return _measure(scores, "high_risk_provider_pct", share, by)


def fraud_loss_exposure(scores: DataFrame, by: By = None) -> DataFrame:
    paid = F.round(F.col("total_reimbursed") * 100).cast("bigint")
    return _measure(
        scores, "total_fraud_loss_exposure", _usd(F.sum(F.when(F.col("potential_fraud"), paid))), by
    )


def inpatient_cost_ratio(drill: DataFrame, by: By = None) -> DataFrame:
    paid = cents(F.col("reimbursed_amount"))
    inpatient = F.sum(F.when(F.col("claim_type") == "Inpatient", paid))
    return _measure(drill, "inpatient_cost_ratio_pct", _pct(inpatient, F.sum(paid)), by)


def fraud_rate_rag(drill: DataFrame, by: By = None) -> DataFrame:
    """RED above 35 percent, AMBER from 20, GREEN below."""
    rate = portfolio_fraud_rate(drill, by)
    status = (
        F.when(F.col("portfolio_fraud_rate_pct") > RED_ABOVE, "RED")
        .when(F.col("portfolio_fraud_rate_pct") >= AMBER_FROM, "AMBER")
        .otherwise("GREEN")
    )
    return rate.select(*(by or []), status.alias("fraud_rate_rag_status"))


def _lookup(value: Column, colours: dict[str, str], default: str) -> Column:
    chosen = F.lit(default)
    for key, colour in colours.items():
        chosen = F.when(value == key, colour).otherwise(chosen)
    return chosen


def fraud_rate_colour(drill: DataFrame, by: By = None) -> DataFrame:
    status = fraud_rate_rag(drill, by)
    colour = _lookup(F.col("fraud_rate_rag_status"), RAG_COLOURS, RAG_DEFAULT)
    return status.select(*(by or []), colour.alias("fraud_rate_hex_color"))


def _selected(column: str, default: Column) -> Column:
    """The value when exactly one is selected, otherwise the default."""
    lone = (F.min(column) == F.max(column)) & (F.count("*") == F.count(column))
    return F.when(lone, F.min(column)).otherwise(default)


def risk_badge_colour(scores: DataFrame, by: By = None) -> DataFrame:
    selected = scores.groupBy(*(by or [])).agg(_selected("risk_tier", F.lit(None)).alias("tier"))
    return selected.select(
        *(by or []), _lookup(F.col("tier"), TIER_COLOURS, TIER_DEFAULT).alias("provider_risk_badge_color")
    )


def _month_number() -> Column:
    month = F.col("claim_year_month")
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int")


def _prior(trends: DataFrame) -> DataFrame:
    """Trends with the claims of the calendar month before; one row per month."""
    previous = Window.orderBy("_month").rangeBetween(-1, -1)
    return trends.withColumn("_month", _month_number()).withColumn(
        "prior_month_claims", F.sum("total_claims").over(previous)
    )


def prior_month_claims(trends: DataFrame) -> DataFrame:
    return _prior(trends).select("claim_year_month", "total_claims", "prior_month_claims")


def month_growth(trends: DataFrame) -> DataFrame:
    prior = F.col("prior_month_claims")
    growth = F.when(prior.isNotNull(), _pct(F.col("total_claims") - prior, prior))
    return _prior(trends).select("claim_year_month", growth.alias("mom_claim_volume_growth_pct"))


def rolling_reimbursement(trends: DataFrame) -> DataFrame:
    """Average over the last three calendar months that have claims."""
    recent = Window.orderBy("_month").rangeBetween(-2, 0)
    paid = cents(F.col("total_reimbursement").cast("decimal(18,2)"))
    average = F.sum(paid).over(recent).cast("double") / F.count(paid).over(recent) / 100
    return trends.withColumn("_month", _month_number()).select(
        "claim_year_month", average.alias("rolling_3_month_avg_reimbursement")
    )


def provider_rank(drill: DataFrame, scores: DataFrame) -> DataFrame:
    """Dense rank of every selected provider by money; without claims 0.

    Ranks are given to the distinct totals, which are numbered over
    range-partitioned slices, and then looked up per provider. Providers without
    money would all meet on one total, so their rank is one number for them.
    """
    totals = drill.groupBy("provider_id").agg(sum_cents("reimbursed_amount").alias("paid"))
    providers = (
        scores.select("provider_id")
        .join(totals, "provider_id", "left")
        .select("provider_id", F.coalesce("paid", F.lit(0)).alias("paid"))
    )
    ranks = checkpointed(global_row_number(providers.select("paid").distinct(), [F.desc("paid")], "rank"))
    of_none = ranks.where("paid = 0").agg(F.max("rank")).scalar()
    ranked = providers.where("paid <> 0").join(ranks, "paid").select(*providers.columns, "rank")
    return ranked.union(providers.where("paid = 0").select("*", of_none)).select(
        "provider_id",
        as_money(F.col("paid")).alias("total_reimbursement"),
        F.col("rank").alias("provider_state_reimbursement_rank"),
    )


def provider_summary(scores: DataFrame, by: By = None) -> DataFrame:
    """Header text of the selected provider, with defaults when none is."""
    selected = scores.groupBy(*(by or [])).agg(
        _selected("provider_id", F.lit(NO_PROVIDER)).alias("id"),
        _selected("fraud_risk_probability", F.lit(NO_PROBABILITY)).alias("p"),
        _selected("risk_tier", F.lit(NO_TIER)).alias("tier"),
    )
    # Half-up on the percent with one decimal, as a fixed-point number.
    percent = F.round(F.col("p").cast("decimal(12,6)") * 100, 1).cast("decimal(6,1)").cast("string")
    text = F.format_string(SUMMARY_FORMAT, "id", percent, "tier")
    return selected.select(*(by or []), text.alias("selected_provider_risk_summary"))
