"""Leakage-safe provider split, class weight and cross-validation folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.operators.ranking import hash_ranked

LABEL = "potential_fraud"


def _ranked_with_size(features: DataFrame, seed: int) -> DataFrame:
    """Providers numbered within their class in md5 order, with the class size."""
    sizes = features.agg(
        F.struct(F.count_if(F.col(LABEL)).alias("fraud"), F.count_if(~F.col(LABEL)).alias("clean")).alias("n")
    ).scalar()
    return (
        hash_ranked(features, "provider_id", LABEL, seed)
        .withColumn("_n", sizes)
        .withColumn("_class_size", F.when(F.col(LABEL), F.col("_n.fraud")).when(~F.col(LABEL), F.col("_n.clean")))
        .drop("_n")
    )


def group_split(features: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split``: per class, ``max(1, int(n * test_size))`` providers are test.

    A provider has one row and one md5 rank, so it lies on exactly one side.
    Providers without a label are neither class and stay on the train side.
    """
    places = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("_class_size") * test_size))
    test = F.coalesce(F.col("hash_rank") <= places, F.lit(False))
    return (
        _ranked_with_size(features, seed)
        .withColumn("split", F.when(test, "test").otherwise("train"))
        .select(*features.columns, "split")
    )


def assert_disjoint(split: DataFrame) -> DataFrame:
    """Raise when a provider lies on both sides."""
    train, test = (split.where(F.col("split") == side).select("provider_id") for side in ("train", "test"))
    shared = train.join(test, "provider_id", "left_semi").limit(1).count()
    if shared:
        raise ValueError("a provider lies in both train and test")
    return split


def split_summary(split: DataFrame) -> DataFrame:
    """Per side: providers, flagged, clean, flagged share."""
    return split.groupBy("split").agg(
        F.count("*").alias("providers"),
        F.count_if(F.col(LABEL)).alias("fraud"),
        F.count_if(~F.col(LABEL)).alias("clean"),
        F.avg(F.col(LABEL).cast("double")).alias("fraud_rate"),
    )


def class_weight(train: DataFrame) -> DataFrame:
    """One row: negatives, positives and their ratio (positives at least 1)."""
    counts = train.agg(
        F.count_if(~F.col(LABEL)).alias("negatives"), F.count_if(F.col(LABEL)).alias("positives")
    )
    return counts.withColumn(
        "scale_pos_weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1).cast("bigint"))
    )


def fold_assignment(train: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` 0..folds-1, each class dealt out evenly in md5 order."""
    ranked = hash_ranked(train, "provider_id", LABEL, seed)
    return ranked.withColumn("fold", ((F.col("hash_rank") - 1) % folds).cast("int")).drop("hash_rank")
