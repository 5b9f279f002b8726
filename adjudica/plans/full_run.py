"""The whole job: raw files to star, queries, features, model, reasons, marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from adjudica.operators import attribution, marts, model, quality, sampling
from adjudica.operators.analytics import ANALYTICS, orphan_claims
from adjudica.operators.features import assert_no_leakage, provider_features
from adjudica.operators.star import claim_keys
from adjudica.session import shuffles_dropped
from adjudica.sources.raw_files import read_raw
from adjudica.sources.sinks import write_json, write_mart
from adjudica.sources.star_store import load_star, read_star


@dataclass
class FullRun:
    """Folders and frames a run leaves behind."""

    out: str
    features: DataFrame
    trained: model.TrainedModel
    scores: DataFrame
    attributions: DataFrame


def load(
    spark: SparkSession, raw_dir: str, out: str, sample: int | None = None, fail_fast: bool = True
) -> None:
    """Read, audit and store the star; an error rule stops the run after the report."""
    raw = read_raw(spark, raw_dir)
    if sample:
        raw = sampling.sample_raw(raw, sample)
    write_json(quality.audit(spark, raw), f"{out}/audit")
    write_json(quality.raw_metrics(raw), f"{out}/raw_metrics")
    if fail_fast:
        quality.enforce(spark.read.json(f"{out}/audit"))
    star = load_star(raw, f"{out}/star")
    write_json(quality.star_audit(star), f"{out}/star_audit")
    if fail_fast:
        quality.enforce_star(spark.read.json(f"{out}/star_audit"))
    # Against the stored dimensions: the orphans are what the load left out.
    orphans = orphan_claims(claim_keys(raw), star["dim_providers"], star["dim_beneficiaries"])
    write_mart(orphans, f"{out}/queries/q08_orphan_claims")


def run(
    spark: SparkSession,
    raw_dir: str | None,
    out: str,
    sample: int | None = None,
    fail_fast: bool = True,
    rounds: int = model.ROUNDS,
    folds: int = model.FOLDS,
    threshold: float = marts.DEFAULT_THRESHOLD,
    explained_rows: int | None = None,
) -> FullRun:
    """Every stage in order; ``raw_dir=None`` starts from a star stored in ``out``.

    ``threshold`` cuts tiers, predictions and narratives. Its default matches
    published behaviour; pass the tuned value of the bundle to use that. All
    providers are explained, or a sample of ``explained_rows`` of them.
    """
    if raw_dir is not None:
        load(spark, raw_dir, out, sample, fail_fast)
    star = read_star(spark, f"{out}/star")
    for name, build in ANALYTICS.items():
        write_mart(build(star), f"{out}/queries/{name}")
    with shuffles_dropped(spark):
        assert_no_leakage(provider_features(star)).write.mode("overwrite").parquet(f"{out}/features")
    features = spark.read.parquet(f"{out}/features")

    trained = model.train_and_evaluate(features, rounds, folds)
    model.save_bundle(trained, f"{out}/model")
    write_json(trained.baselines, f"{out}/reports/baselines")
    if trained.cross_validation is not None:
        write_json(trained.cross_validation, f"{out}/reports/cross_validation")
    model.score(trained.trees, features).write.mode("overwrite").parquet(f"{out}/scores")
    scores = spark.read.parquet(f"{out}/scores")

    explained = sampling.sample_rows(features, explained_rows) if explained_rows else features
    phi = attribution.attributions(trained.trees, explained)
    phi.write.mode("overwrite").parquet(f"{out}/attributions")
    phi = spark.read.parquet(f"{out}/attributions")
    write_json(attribution.global_importance(phi), f"{out}/reports/importance")
    told = scores.join(explained.select("provider_id"), "provider_id", "left_semi")
    write_json(attribution.explanation_summary(phi, told, threshold), f"{out}/reports/explanation")

    for name, table in marts.all_marts(star, features, scores, threshold).items():
        write_mart(table, f"{out}/marts/{name}")
    return FullRun(out, features, trained, scores, phi)
