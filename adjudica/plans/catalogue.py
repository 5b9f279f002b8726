"""Every registered query: name -> (spark, input folder) -> DataFrame.

Names start with the inventory id they cover. Metrics, marts and narratives
are registered on stand-in scores, which plain SQL can reproduce, and again on
the trained model.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions import cleanse
from adjudica.operators import analytics, attribution, dashboards, marts, measures, metrics, model, quality, sampling, split, star
from adjudica.operators.boosting import NODES, Forest
from adjudica.operators.features import FEATURES
from adjudica.plans.portable import portable
from adjudica.plans.staging import (
    scratch,
    staged_attributions,
    staged_features,
    staged_model,
    staged_path,
    staged_scores,
    staged_star,
)
from adjudica.schema import ANNUAL_AMOUNTS, CONDITIONS
from adjudica.sources.raw_files import RAW_FILES, read_raw, write_raw
from adjudica.sources.sinks import write_json, write_mart
from adjudica.sources.star_store import (
    broadcast_if_small,
    count_rows,
    reconcile_counts,
    table_counts,
    write_star,
)
from adjudica.sources.testdata import STANDIN_NODES, hashed_attributions, hashed_scores, raw_tables

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.date(2024, 1, 1)
REPORTED_PROVIDER = "PRV3"
FILTER_STATES = [1, 5, 10]
FILTER_CLAIMS = 100


def _on_star(build) -> Query:
    return lambda spark, sf_dir: portable(build(staged_star(spark, sf_dir)))


def _on_raw(build) -> Query:
    return lambda spark, sf_dir: portable(build(raw_tables(spark, sf_dir)))


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of places; their last bits depend on row order.

    Adding 0.0 turns a rounded -0.0 into 0.0.
    """
    return df.select(
        *[
            (F.round(F.col(name), digits) + F.lit(0.0)).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# --- raw tables -------------------------------------------------------------


def _dims(raw) -> tuple[DataFrame, DataFrame]:
    return star.build_beneficiaries(raw["beneficiary"]), star.build_providers(raw["labels"])


def _read_raw(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch(spark, sf_dir, f"raw_{table}")
        write_raw({table: raw_tables(spark, sf_dir)[table]}, folder)
        return read_raw(spark, folder, {table: RAW_FILES[table]})[table]

    return run


def _flags(raw) -> DataFrame:
    return raw["beneficiary"].select(
        "BeneID", *[cleanse.decode_flag(source).alias(name) for source, name in CONDITIONS.items()]
    )


def _dates(raw) -> DataFrame:
    """Date columns of all three tables, one row per record."""
    claims = [
        raw["inpatient"].select(
            "ClaimID", *[cleanse.lenient_date(c).alias(c) for c in ["ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt"]]
        ),
        raw["outpatient"].select(
            "ClaimID", *[cleanse.lenient_date(c).alias(c) for c in ["ClaimStartDt", "ClaimEndDt"]],
        ),
        raw["beneficiary"].select(
            F.col("BeneID").alias("ClaimID"), cleanse.lenient_date("DOB").alias("ClaimStartDt"),
            cleanse.lenient_date("DOD").alias("ClaimEndDt"),
        ),
    ]
    return claims[0].unionByName(claims[1], True).unionByName(claims[2], True)


def _codes(raw) -> DataFrame:
    columns = [
        "AttendingPhysician", "OperatingPhysician", "OtherPhysician", "ClmAdmitDiagnosisCode",
        "DiagnosisGroupCode", "ClmDiagnosisCode_1", "ClmProcedureCode_1",
    ]
    return raw["inpatient"].select("ClaimID", *[cleanse.null_tokens(c).alias(c) for c in columns])


def _stays(raw) -> DataFrame:
    admission, discharge = cleanse.lenient_date("AdmissionDt"), cleanse.lenient_date("DischargeDt")
    return raw["inpatient"].select(
        "ClaimID", cleanse.length_of_stay(admission, discharge).alias("length_of_stay")
    )


def _amounts(raw) -> DataFrame:
    return raw["beneficiary"].select(
        "BeneID", *[cleanse.money_or_zero(c).alias(name) for c, name in ANNUAL_AMOUNTS.items()]
    )


def _defaults(raw) -> DataFrame:
    """Undecoded conditions and amounts, filled with the declared defaults."""
    undecoded = raw["beneficiary"].select(
        "BeneID",
        *[(F.trim(source) == "1").alias(name) for source, name in [("RenalDiseaseIndicator", "renal_disease")]],
        *[
            F.when(cleanse.null_tokens(source).isNotNull(), F.trim(source) == "1").alias(name)
            for source, name in CONDITIONS.items()
        ],
        *[F.col(source).try_cast("decimal(12,2)").alias(name) for source, name in ANNUAL_AMOUNTS.items()],
    )
    return star.apply_defaults(undecoded)


def _star_counts(raw) -> DataFrame:
    return count_rows(star.build_star(raw))


def _orphans(claims) -> Callable[[dict[str, DataFrame]], DataFrame]:
    def run(raw) -> DataFrame:
        beneficiaries, providers = _dims(raw)
        return analytics.orphan_claims(claims(raw), providers, beneficiaries)

    return run


def _staged_keys(raw) -> DataFrame:
    beneficiaries, providers = _dims(raw)
    return quality.foreign_key_audit({"fact_claims_unified": star.staged_claims(raw)}, providers, beneficiaries)


def _sample(n: int):
    return lambda raw: sampling.stratified_sample(raw["labels"], n)


def _sampled_claims(raw) -> DataFrame:
    labels = sampling.stratified_sample(raw["labels"], 40)
    return sampling.restrict_claims(raw["inpatient"], labels).select("ClaimID", "Provider")


def _active_benes(raw) -> DataFrame:
    active = sampling.active_beneficiaries(raw["beneficiary"], raw["inpatient"], raw["outpatient"])
    return active.select("BeneID", "State")


RAW_QUERIES = {
    "e01_build_providers": lambda raw: star.build_providers(raw["labels"]),
    "e02_build_beneficiaries": lambda raw: star.build_beneficiaries(raw["beneficiary"]),
    "e03_decode_flag": _flags,
    "e04_decode_renal": lambda raw: raw["beneficiary"].select(
        "BeneID", cleanse.decode_renal("RenalDiseaseIndicator").alias("renal_disease")
    ),
    "e05_lenient_dates": _dates,
    "e06_null_tokens": _codes,
    "e07_length_of_stay": _stays,
    "e08_dedup_first": lambda raw: star.dedup_first(star.clean_outpatient(raw["outpatient"]), "claim_id"),
    "e09_referential_filter": lambda raw: star.referential_filter(
        star.clean_inpatient(raw["inpatient"]), *_dims(raw)
    ).select("claim_id", "bene_id", "provider_id", "claim_start_date"),
    "e10_build_inpatient": lambda raw: star.build_inpatient(raw["inpatient"], *_dims(raw)),
    "e11_build_outpatient": lambda raw: star.build_outpatient(raw["outpatient"], *_dims(raw)),
    "e12_unify_claims": star.staged_claims,
    "e13_money_or_zero": _amounts,
    "e14_star_counts": _star_counts,
    "p01_stratified_sample_500": _sample(500),
    "p01_stratified_sample_40": _sample(40),
    "p02_restrict_claims": _sampled_claims,
    "p03_active_beneficiaries": _active_benes,
    "v06_raw_metrics": quality.raw_metrics,
    "c03_foreign_keys_staged": _staged_keys,
    "c10_column_defaults": _defaults,
    "q08_orphan_claims": _orphans(star.staged_claims),
    "q08_orphan_claims_read": _orphans(star.claim_keys),
}


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit(spark, raw_tables(spark, sf_dir), AS_OF)


# --- star tables ------------------------------------------------------------

STAR_QUERIES = {
    **analytics.ANALYTICS,
    "q12_payout_deciles_all": analytics.payout_deciles,
    "s02_read_star": lambda s: s["fact_claims_unified"].select(
        "claim_id", "claim_type", "bene_id", "provider_id", "claim_start_date", "reimbursed_amount",
        "deductible_amount", "length_of_stay", "attending_physician", "operating_physician",
        "primary_diagnosis_code",
    ),
    "c01_constraints": quality.constraint_audit,
    "c02_primary_keys": quality.primary_key_audit,
    "c03_foreign_keys": lambda s: quality.foreign_key_audit(s, s["dim_providers"], s["dim_beneficiaries"]),
    "b04_temporal_trends": marts.temporal_trends,
    "b05_state_geographic_summary": marts.state_geographic_summary,
    "a16_prior_month_claims": lambda s: measures.prior_month_claims(marts.temporal_trends(s)),
    "a17_month_growth": lambda s: _rounded(measures.month_growth(marts.temporal_trends(s))),
    "a18_rolling_reimbursement": lambda s: _rounded(measures.rolling_reimbursement(marts.temporal_trends(s))),
    "g01_claim_type_mix": lambda s: _rounded(dashboards.claim_type_mix(s)),
    "g02_flagged_states": dashboards.flagged_states,
    "g06_condition_prevalence": lambda s: _rounded(dashboards.condition_prevalence(s)),
    "g07_stay_histogram": dashboards.stay_histogram,
    "g07_stay_quartiles": dashboards.stay_quartiles,
    "g08_same_day_distribution": dashboards.same_day_distribution,
    "g09_claim_audit": lambda s: dashboards.claim_audit(s, REPORTED_PROVIDER),
    "g10_physician_network": lambda s: _rounded(dashboards.physician_network(s)),
}


def _rewritten_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the star a second time and count what arrived."""
    path = scratch(spark, sf_dir, "star_copy")
    write_star(staged_star(spark, sf_dir), path)
    return table_counts(spark, path)


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = table_counts(spark, staged_path(spark, sf_dir))
    return reconcile_counts(written, count_rows(star.build_star(raw_tables(spark, sf_dir))))


def _mart_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = portable(marts.temporal_trends(staged_star(spark, sf_dir)))
    path = write_mart(trends, scratch(spark, sf_dir, "trends_csv"), "csv")
    return spark.read.option("header", True).schema(trends.schema).csv(path)


def _json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    importance = _rounded(attribution.global_importance(_given_phi(spark, sf_dir)))
    path = write_json(importance, scratch(spark, sf_dir, "importance_json"))
    return spark.read.schema(importance.schema).json(path)


# --- features, split, metrics -----------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(staged_features(spark, sf_dir))


def _flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    deciles = analytics.payout_deciles(staged_star(spark, sf_dir)).select("provider_id", "payout_decile")
    return _features(spark, sf_dir).join(deciles, "provider_id", "left")


def _given_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_scores(staged_features(spark, sf_dir))


def _given_phi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_attributions(_features(spark, sf_dir), FEATURES)


def _labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.as_scored(_given_scores(spark, sf_dir))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.group_split(staged_features(spark, sf_dir))


def _side(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return _split(spark, sf_dir).where(F.col("split") == side)


def _on_split(build) -> Query:
    return lambda spark, sf_dir: portable(build(_split(spark, sf_dir)))


def _on_train(build) -> Query:
    return lambda spark, sf_dir: portable(build(_side(spark, sf_dir, "train")))


def _on_scored(build) -> Query:
    return lambda spark, sf_dir: portable(_rounded(build(_labelled_scores(spark, sf_dir))))


def _majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = (
        _side(spark, sf_dir, side).select(F.col("potential_fraud").cast("int").alias("label"))
        for side in ("train", "test")
    )
    return _rounded(metrics.majority_baseline(train, test))


def _tuned_cut(scored: DataFrame) -> DataFrame:
    cut = metrics.best_threshold(metrics.pr_curve(scored)).select("threshold").scalar()
    return metrics.threshold_metrics(scored, cut)


def _evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.evaluation_report(_labelled_scores(spark, sf_dir), 0.7)
    return _rounded(
        report.select(
            "roc_auc", "pr_auc",
            *[
                F.col(f"{block}_threshold.{name}").alias(f"{block}_{name}")
                for block in ("default", "tuned")
                for name in ("precision", "recall", "f1_score")
            ],
            F.col("tuned_threshold.confusion_matrix")[0][0].alias("tuned_tn"),
            F.col("tuned_threshold.confusion_matrix")[1][1].alias("tuned_tp"),
        )
    )


# --- marts and measures -----------------------------------------------------


def _risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.provider_risk_scores(staged_features(spark, sf_dir), _given_scores(spark, sf_dir))


def _on_risk(build) -> Query:
    return lambda spark, sf_dir: portable(_rounded(build(_risk(spark, sf_dir))))


def _drill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.claims_drillthrough(staged_star(spark, sf_dir), _risk(spark, sf_dir))


def _portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every claim in the drill-through shape the claim measures read."""
    s = staged_star(spark, sf_dir)
    labels = s["dim_providers"].select("provider_id", F.col("fraud_label").alias("ground_truth_fraud"))
    return s["fact_claims_unified"].join(broadcast_if_small(labels), "provider_id")


def _on_portfolio(build) -> Query:
    return lambda spark, sf_dir: portable(_rounded(build(_portfolio(spark, sf_dir))))


def _provider_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.provider_rank(staged_star(spark, sf_dir)["fact_claims_unified"], staged_features(spark, sf_dir))


def _kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.kpi_summary(staged_star(spark, sf_dir), staged_features(spark, sf_dir))


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dashboards.filter_providers(
        _risk(spark, sf_dir), staged_star(spark, sf_dir), ["High Risk", "Medium Risk"], FILTER_STATES, FILTER_CLAIMS
    )
    return kept.select("provider_id", "risk_tier", F.col("total_claims").cast("bigint").alias("total_claims"))


def _export_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = marts.all_marts(
        staged_star(spark, sf_dir), staged_features(spark, sf_dir), staged_scores(spark, sf_dir)
    )
    written = {}
    for name, df in tables.items():
        path = write_mart(df, scratch(spark, sf_dir, f"marts/{name}"), "csv")
        written[name] = spark.read.option("header", True).csv(path)
    return count_rows(written)


CLAIM_MEASURES = {
    "a01_total_claims": measures.total_claims,
    "a02_total_reimbursement": measures.total_reimbursement,
    "a03_avg_claim_cost": measures.avg_claim_cost,
    "a04_total_deductibles_paid": measures.total_deductibles_paid,
    "a06_total_beneficiaries": measures.total_beneficiaries,
    "a07_fraud_claims_count": measures.fraud_claims_count,
    "a08_portfolio_fraud_rate": measures.portfolio_fraud_rate,
    "a12_inpatient_cost_ratio": measures.inpatient_cost_ratio,
    "a13_fraud_rate_rag": measures.fraud_rate_rag,
    "a14_fraud_rate_colour": measures.fraud_rate_colour,
}
SCORE_MEASURES = {
    "a05_active_providers": measures.active_providers,
    "a09_predicted_high_risk": measures.predicted_high_risk,
    "a10_high_risk_provider_pct": measures.high_risk_provider_pct,
    "a11_fraud_loss_exposure": measures.fraud_loss_exposure,
    "a15_risk_badge_colour": measures.risk_badge_colour,
    "a20_provider_summary": measures.provider_summary,
}


# --- trained model ----------------------------------------------------------


def _cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _side(spark, sf_dir, "train").drop("split")
    return model.cross_validate(train, model.positive_weight(train))


def _logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, _ = staged_model(spark, sf_dir)
    return model.score(trained.logistic, staged_features(spark, sf_dir))


def _bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = staged_model(spark, sf_dir)
    loaded = model.load_bundle(spark, path)
    sides = loaded.split.groupBy("split").agg(F.count("*").alias("providers"))
    return sides.withColumn("threshold", F.lit(loaded.threshold)).withColumn(
        "features", F.lit(len(loaded.feature_names))
    )


def _on_model_phi(build) -> Query:
    return lambda spark, sf_dir: build(staged_attributions(spark, sf_dir), staged_scores(spark, sf_dir))


def _on_given_phi(build) -> Query:
    return lambda spark, sf_dir: portable(
        _rounded(build(_given_phi(spark, sf_dir), _given_scores(spark, sf_dir)))
    )


def _told(phi: DataFrame, scores: DataFrame) -> DataFrame:
    return attribution.narratives(phi, scores).withColumn(
        "decision_rationale", F.array_join("decision_rationale", "\n")
    )


def _standin_forest(spark: SparkSession, sf_dir: str) -> Forest:
    """The stand-in forest after it was saved and loaded."""
    rows = [(t, i, l, r, FEATURES.index(f) if f else -1, c, v, n) for t, i, l, r, f, c, v, n in STANDIN_NODES]
    names = ["tree", "id", "left", "right", "feature", "cut", "value", "cover"]
    path = scratch(spark, sf_dir, "standin-forest")
    Forest(pd.DataFrame(rows, columns=names), FEATURES).save(spark, path)
    return Forest.load(spark, path, FEATURES)


def _standin_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = spark.createDataFrame(_standin_forest(spark, sf_dir).nodes, NODES)
    feature = F.when(F.col("left") >= 0, F.get(F.array(*map(F.lit, FEATURES)), "feature"))
    cut = F.when(F.col("left") >= 0, F.col("cut"))
    return portable(nodes.select("tree", "id", F.col("left").alias("left_child"), F.col("right").alias("right_child"), feature.alias("feature"), cut.alias("cut"), "value", "cover"))


def _standin_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.score(_standin_forest(spark, sf_dir), staged_features(spark, sf_dir))


def _standin_phi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attributions(_standin_forest(spark, sf_dir), staged_features(spark, sf_dir))


def _on_standin(build) -> Query:
    return lambda spark, sf_dir: portable(_rounded(build(_standin_phi(spark, sf_dir), _standin_scores(spark, sf_dir))))


def _additive(phi: DataFrame, scores: DataFrame) -> DataFrame:
    """Each provider's log-odds, from its score and from the attributions of its features."""
    told = phi.groupBy("provider_id").agg(F.sum("phi").alias("phi_sum"))
    odds = F.log(F.col("probability") / (1 - F.col("probability"))).alias("log_odds")
    return scores.join(told, "provider_id").select("provider_id", odds, "phi_sum")


def _summary(phi: DataFrame, scores: DataFrame) -> DataFrame:
    case = F.col("high_risk_case")
    return attribution.explanation_summary(phi, scores).select(
        F.array_join(F.transform("top_features", lambda f: f["feature"]), ",").alias("top_features"),
        case["provider_id"].alias("provider_id"), case["assigned_risk_tier"].alias("assigned_risk_tier"),
        F.array_join(case["decision_rationale"], "\n").alias("decision_rationale"),
    )


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {"flagship_provider_profile": _flagship}
    found |= {f"s01_read_raw_{table}": _read_raw(table) for table in ("labels", "beneficiary", "inpatient", "outpatient")}
    found |= {name: _on_raw(build) for name, build in RAW_QUERIES.items()}
    found |= {name: _on_star(build) for name, build in STAR_QUERIES.items()}
    found |= {
        "s03_write_star": _rewritten_counts,
        "s04_table_counts": lambda spark, sf_dir: table_counts(spark, staged_path(spark, sf_dir)),
        "s05_reconcile_counts": _reconciled,
        "s06_write_mart": _mart_round_trip,
        "s07_write_json": _json_round_trip,
        "v01_raw_audit": _audit,
        "v14_audit_summary": lambda spark, sf_dir: quality.audit_summary(_audit(spark, sf_dir)),
        "f01_provider_features": _features,
        "p04_sample_rows": lambda spark, sf_dir: sampling.sample_rows(staged_features(spark, sf_dir)).select("provider_id"),
        "p04_sample_rows_25": lambda spark, sf_dir: sampling.sample_rows(staged_features(spark, sf_dir), 25).select("provider_id"),
        "m01_group_split": _on_split(lambda df: df.select("provider_id", "potential_fraud", "split")),
        "m02_split_summary": _on_split(lambda df: _rounded(split.split_summary(df))),
        "m03_class_weight": _on_train(lambda df: _rounded(split.class_weight(df), 4)),
        "m04_majority_baseline": _majority,
        "m07_fold_assignment": _on_train(lambda df: split.fold_assignment(df).select("provider_id", "fold")),
        "m09_pr_curve": _on_scored(metrics.pr_curve),
        "m10_best_threshold": _on_scored(lambda df: metrics.best_threshold(metrics.pr_curve(df))),
        "m11_threshold_metrics": _on_scored(lambda df: metrics.threshold_metrics(df, 0.5)),
        "m11_tuned_metrics": _on_scored(_tuned_cut),
        "m12_roc_auc": _on_scored(lambda df: metrics.roc_auc(metrics.score_steps(df))),
        "m13_average_precision": _on_scored(lambda df: metrics.average_precision(metrics.score_steps(df))),
        "m14_evaluation_report": _evaluation,
        "b01_provider_risk_scores": _on_risk(lambda df: df),
        "b02_risk_tiers": _on_risk(lambda df: df.groupBy("risk_tier").agg(F.count("*").alias("providers"))),
        "b03_kpi_summary": lambda spark, sf_dir: portable(_kpi(spark, sf_dir)),
        "b06_claims_drillthrough": lambda spark, sf_dir: portable(_drill(spark, sf_dir)),
        "a19_provider_rank": lambda spark, sf_dir: portable(_provider_rank(spark, sf_dir)),
        "a15_risk_badge_colour_by_provider": _on_risk(lambda df: measures.risk_badge_colour(df, ["provider_id"])),
        "a20_provider_summary_by_provider": _on_risk(
            lambda df: measures.provider_summary(df.withColumn("selected", F.col("provider_id")), ["selected"])
        ),
        "g03_provider_quadrant": _on_risk(dashboards.provider_quadrant),
        "g04_risk_queue": _on_risk(dashboards.risk_queue),
        "g05_filter_providers": _filtered,
        "x02_global_importance": _on_given_phi(lambda phi, _: attribution.global_importance(phi)),
        "x03_top_features": _on_given_phi(
            lambda phi, _: attribution.top_features(attribution.global_importance(phi))
        ),
        "x04_top_feature_values": _on_given_phi(
            lambda phi, _: attribution.top_feature_values(phi, attribution.global_importance(phi))
        ),
        "x05_highest_risk": _on_given_phi(lambda _, scores: attribution.highest_risk(scores)),
        "x06_contribution_breakdown": _on_given_phi(lambda phi, _: attribution.contribution_breakdown(phi)),
        "x07_narratives": _on_given_phi(_told),
    }
    found |= {name: _on_portfolio(build) for name, build in CLAIM_MEASURES.items()}
    found |= {
        f"{name}_by_type": _on_portfolio(lambda df, build=build: build(df, ["claim_type"]))
        for name, build in CLAIM_MEASURES.items()
    }
    found |= {name: _on_risk(build) for name, build in SCORE_MEASURES.items()}
    found |= {
        "m08_scores": lambda spark, sf_dir: portable(_rounded(_standin_scores(spark, sf_dir))),
        "s08_forest_round_trip": _standin_bundle,
        "x01_standin_attributions": _on_standin(lambda phi, _: phi),
        "x01_additivity": _on_standin(_additive),
        "x07_standin_narratives": _on_standin(_told),
        "x08_standin_summary": _on_standin(_summary),
        "m05_logistic_scores": _logistic_scores,
        "m06_tree_scores": lambda spark, sf_dir: staged_scores(spark, sf_dir),
        "m07_cross_validation": _cross_validation,
        "m15_baselines": lambda spark, sf_dir: staged_model(spark, sf_dir)[0].baselines,
        "m15_model_evaluation": lambda spark, sf_dir: staged_model(spark, sf_dir)[0].evaluation,
        "s08_model_bundle": _bundle,
        "x01_attributions": _on_model_phi(lambda phi, _: phi),
        "x02_model_importance": _on_model_phi(lambda phi, _: attribution.global_importance(phi)),
        "x07_model_narratives": _on_model_phi(attribution.narratives),
        "x08_explanation_summary": _on_model_phi(attribution.explanation_summary),
        "b07_export_all": _export_all,
    }
    return found
