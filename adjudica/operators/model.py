"""Provider classifier: baselines, boosted trees, folds, tuning, evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.operators import boosting, logistic, metrics
from adjudica.operators.boosting import Forest, Settings
from adjudica.operators.features import FEATURES
from adjudica.operators.logistic import Logistic
from adjudica.operators.split import LABEL, assert_disjoint, class_weight, fold_assignment, group_split
from adjudica.session import checkpointed, side_by_side

# Training parameters of the boosted trees.
ROUNDS = 180
MAX_DEPTH = 5
LEARNING_RATE = 0.04
ROW_SHARE = 0.85
COLUMN_SHARE = 0.80
SEED = 42
FOLDS = 5
BASELINE_CUT = 0.5
ROWS_PER_PARTITION = 50_000


def vectorised(features: DataFrame) -> DataFrame:
    """Feature vector and numeric label; missing features become 0 here only."""
    filled = features.fillna(0.0, subset=FEATURES).withColumn("label", F.col(LABEL).cast("double"))
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(filled)


def _labelled(features: DataFrame) -> DataFrame:
    return vectorised(features).where("label IS NOT NULL")


def _packed(vectors: DataFrame) -> DataFrame:
    """Training rows in partitions of even, useful size, kept for all rounds.

    A provider's partition and its place there follow from its id alone, and their
    number from the number of rows, so the seeded row sampling of the trees does
    not depend on how the input was laid out.
    """
    rows = vectors.count()
    dealt = vectors.repartition(max(1, -(-rows // ROWS_PER_PARTITION)), "provider_id")
    return dealt.sortWithinPartitions("provider_id").persist()


def with_probability(model, vectors: DataFrame, out: str = "probability") -> DataFrame:
    """Adds the probability of the flagged class, by a forest or a logistic regression."""
    if isinstance(model, Forest):
        return boosting.with_probability(model, vectors, out)
    return vectors.withColumn(out, model.probability())


def score(model, features: DataFrame) -> DataFrame:
    """(provider_id, potential_fraud, probability) of every provider."""
    return with_probability(model, vectorised(features)).select("provider_id", LABEL, "probability")


def as_scored(scores: DataFrame) -> DataFrame:
    """Scores in the (score, label) shape of the metrics."""
    return scores.select(F.col("probability").alias("score"), F.col(LABEL).cast("int").alias("label"))


def _weighted(train: DataFrame, positive_weight: float) -> DataFrame:
    return _labelled(train).withColumn(
        "weight", F.when(F.col("label") == 1, F.lit(positive_weight)).otherwise(F.lit(1.0))
    )


def _settings(rounds: int, seed: int) -> Settings:
    return Settings(rounds, MAX_DEPTH, LEARNING_RATE, ROW_SHARE, COLUMN_SHARE, seed)


def fit_trees(train: DataFrame, positive_weight: float, rounds: int = ROUNDS, seed: int = SEED) -> Forest:
    """Boosted trees on labelled providers, flagged ones weighted up."""
    return boosting.fit_forests(_weighted(train, positive_weight), FEATURES, _settings(rounds, seed))[-1]


def fit_logistic(train: DataFrame) -> Logistic:
    """Scaled logistic regression with balanced class weights n / (2 n_class)."""
    vectors = _labelled(train)
    sizes = vectors.agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("p")).first()
    share = F.when(F.col("label") == 1, sizes["p"]).otherwise(sizes["n"] - sizes["p"])
    balanced = vectors.withColumn("weight", F.lit(sizes["n"]) / (2 * F.greatest(share, F.lit(1))))
    rows = _packed(balanced.select("provider_id", "features", "label", "weight"))
    try:
        return logistic.fit(rows, FEATURES)
    finally:
        rows.unpersist()


def baselines(train: DataFrame, test: DataFrame, linear_model: Logistic) -> DataFrame:
    """(model, precision, recall, f1_score, roc_auc, pr_auc) of both baselines."""

    def labels(df: DataFrame) -> DataFrame:
        return df.where(F.col(LABEL).isNotNull()).select(F.col(LABEL).cast("int").alias("label"))

    constant = metrics.majority_baseline(labels(train), labels(test)).select(
        F.lit("majority_class").alias("model"), "*"
    )
    scored = as_scored(score(linear_model, test)).where("label IS NOT NULL")
    cut = metrics.threshold_metrics(scored, BASELINE_CUT).select(
        F.struct("precision", "recall", "f1_score").alias("m")
    ).scalar()
    linear = metrics.ranking_metrics(metrics.score_steps(scored)).withColumn("m", cut).select(
        F.lit("logistic_regression").alias("model"), "m.precision", "m.recall", "m.f1_score", "roc_auc", "pr_auc"
    )
    return constant.unionByName(linear)


def positive_weight(train: DataFrame) -> float:
    return float(class_weight(train).first()["scale_pos_weight"])


def fit_with_folds(
    train: DataFrame, weight: float, rounds: int = ROUNDS, folds: int = FOLDS, seed: int = SEED
) -> tuple[Forest, DataFrame]:
    """The forest of all rows, and the scores of the folds, from the same jobs."""
    assigned = checkpointed(fold_assignment(train, folds, seed))
    *parts, whole = boosting.fit_forests(_weighted(assigned, weight), FEATURES, _settings(rounds, seed), folds)
    return whole, _fold_scores(assigned, parts)


def _fold_scores(assigned: DataFrame, forests: list[Forest]) -> DataFrame:
    """One row per fold: roc_auc, recall and f1 at 0.5 on the held-out fold."""

    def one(fold: int) -> DataFrame:
        held_out = as_scored(score(forests[fold], assigned.where(F.col("fold") == fold))).where("label IS NOT NULL")
        cut = metrics.threshold_metrics(held_out, 0.5).select(F.struct("recall", "f1_score").alias("m")).scalar()
        areas = metrics.ranking_metrics(metrics.score_steps(held_out)).withColumn("m", cut)
        return areas.select(F.lit(fold).alias("fold"), "roc_auc", "m.recall", F.col("m.f1_score").alias("f1"))

    spark = assigned.sparkSession
    out, *others = side_by_side(spark, [lambda fold=fold: one(fold) for fold in range(len(forests))])
    for part in others:
        out = out.unionByName(part)
    return out


def cross_validate(
    train: DataFrame, weight: float, rounds: int = ROUNDS, folds: int = FOLDS, seed: int = SEED
) -> DataFrame:
    """One row per fold: roc_auc, recall and f1 at 0.5 on the held-out fold.

    The folds' forests grow in one set of jobs.
    """
    return fit_with_folds(train, weight, rounds, folds, seed)[1]


def cv_summary(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(
        F.avg("roc_auc").alias("roc_auc"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1")
    )


def tune_threshold(model, train: DataFrame) -> float:
    """Cut of the largest F1 on the rows the model was fitted on."""
    curve = metrics.pr_curve(as_scored(score(model, train)).where("label IS NOT NULL"))
    return float(metrics.best_threshold(curve).first()["threshold"])


@dataclass
class TrainedModel:
    """Everything the later steps need from one training run."""

    trees: Forest
    logistic: Logistic
    threshold: float
    weight: float
    split: DataFrame
    baselines: DataFrame
    evaluation: DataFrame
    cross_validation: DataFrame | None = None


def train_and_evaluate(
    features: DataFrame, rounds: int = ROUNDS, folds: int = FOLDS, seed: int = SEED
) -> TrainedModel:
    """Split, baselines, folds, fit, tune on train, evaluate on test.

    ``folds=0`` leaves the cross-validation out.
    """
    split = checkpointed(group_split(features, seed=seed))
    assert_disjoint(split)
    train, test = (split.where(F.col("split") == side).drop("split") for side in ("train", "test"))
    weight = positive_weight(train)
    (trees, per_fold), linear_model = side_by_side(
        features.sparkSession,
        [
            lambda: fit_with_folds(train, weight, rounds, folds, seed) if folds else (fit_trees(train, weight, rounds, seed), None),
            lambda: fit_logistic(train),
        ],
    )
    threshold = tune_threshold(trees, train)
    evaluation = metrics.evaluation_report(
        as_scored(score(trees, test)).where("label IS NOT NULL"), threshold
    ).withColumn("scale_pos_weight", F.round(F.lit(weight), 4))
    return TrainedModel(
        trees, linear_model, threshold, weight, split, baselines(train, test, linear_model), evaluation, per_fold
    )


def save_bundle(model: TrainedModel, path: str) -> str:
    """Models with scaler, feature names, threshold, split ids and metrics."""
    spark = model.split.sparkSession
    model.trees.save(spark, f"{path}/trees")
    model.logistic.save(spark, f"{path}/logistic")
    model.split.select("provider_id", "split").write.mode("overwrite").parquet(f"{path}/split")
    model.evaluation.write.mode("overwrite").json(f"{path}/metrics")
    names = F.array(*[F.lit(name) for name in FEATURES]).alias("feature_names")
    spark.range(1).select(F.lit(model.threshold).alias("threshold"), names).write.mode("overwrite").parquet(
        f"{path}/settings"
    )
    return path


@dataclass
class Bundle:
    trees: Forest
    logistic: Logistic
    threshold: float
    feature_names: list[str]
    split: DataFrame
    metrics: DataFrame


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    settings = spark.read.parquet(f"{path}/settings").first()
    names = list(settings["feature_names"])
    return Bundle(
        Forest.load(spark, f"{path}/trees", names),
        Logistic.load(spark, f"{path}/logistic"),
        settings["threshold"],
        names,
        spark.read.parquet(f"{path}/split"),
        spark.read.json(f"{path}/metrics"),
    )
