"""Tables and models of one input folder, built once per application.

The star is the load step of the job: later queries prune columns and push
filters into its Parquet files. Features, models and attributions are written
once as well, so nothing downstream computes them again or depends on the
executors that made them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from adjudica.operators.attribution import attributions
from adjudica.operators.features import assert_no_leakage, provider_features
from adjudica.operators.model import TrainedModel, save_bundle, score, train_and_evaluate
from adjudica.operators.star import Star
from adjudica.session import shuffles_dropped, work_dir
from adjudica.sources.star_store import load_star, read_star
from adjudica.sources.testdata import raw_tables

_built: set[str] = set()
_models: dict[str, TrainedModel] = {}


def scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder for a written table, private to this application and input."""
    key = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    return f"{work_dir(spark)}/{spark.sparkContext.applicationId}/{key}/{name}"


def _written(spark: SparkSession, path: str, build) -> DataFrame:
    if path not in _built:
        df = build()
        with shuffles_dropped(spark):
            df.write.mode("overwrite").parquet(path)
        _built.add(path)
    return spark.read.parquet(path)


def staged_path(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, sf_dir, "star")
    if path not in _built:
        load_star(raw_tables(spark, sf_dir), path)
        _built.add(path)
    return path


def staged_star(spark: SparkSession, sf_dir: str) -> Star:
    return read_star(spark, staged_path(spark, sf_dir))


def staged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kept(name: str, part: DataFrame) -> DataFrame:
        return _written(spark, scratch(spark, sf_dir, f"feature_parts/{name}"), lambda: part)

    return _written(
        spark,
        scratch(spark, sf_dir, "features"),
        lambda: assert_no_leakage(provider_features(staged_star(spark, sf_dir), kept)),
    )


def staged_model(spark: SparkSession, sf_dir: str) -> tuple[TrainedModel, str]:
    """The trained model without folds, and the folder of its bundle."""
    path = scratch(spark, sf_dir, "bundle")
    if path not in _models:
        model = train_and_evaluate(staged_features(spark, sf_dir), folds=0)
        save_bundle(model, path)
        _models[path] = model
    return _models[path], path


def staged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(provider_id, potential_fraud, probability) from the trained trees."""
    return _written(
        spark,
        scratch(spark, sf_dir, "scores"),
        lambda: score(staged_model(spark, sf_dir)[0].trees, staged_features(spark, sf_dir)),
    )


def staged_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(
        spark,
        scratch(spark, sf_dir, "attributions"),
        lambda: attributions(staged_model(spark, sf_dir)[0].trees, staged_features(spark, sf_dir)),
    )
