"""Exact ranking and threshold metrics from (score, label) rows.

Everything is computed on one row per distinct score. The cumulative counts
use range-partitioned running totals, so millions of distinct scores never
meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.money import safe_ratio
from adjudica.operators.ranking import running_totals

SCORE, LABEL = "score", "label"
MIN_DENOMINATOR = 1e-9


def _positive() -> Column:
    return F.col(LABEL).cast("int") == 1


def score_steps(scored: DataFrame) -> DataFrame:
    """(score, tp, fp, ctp, cfp): counts at and cumulative from the top score."""
    per_score = scored.groupBy(SCORE).agg(
        F.count_if(_positive()).alias("tp"), F.count_if(~_positive()).alias("fp")
    )
    return running_totals(per_score, [F.desc(SCORE)], {"ctp": F.col("tp"), "cfp": F.col("fp")})


def _totals(steps: DataFrame) -> Column:
    return steps.agg(F.struct(F.sum("tp").alias("p"), F.sum("fp").alias("n")).alias("t")).scalar()


def pr_curve(scored: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """(threshold, precision, recall, f1), one row per distinct score."""
    steps = steps if steps is not None else score_steps(scored)
    precision = F.col("ctp") / (F.col("ctp") + F.col("cfp"))
    # Without positives recall is 1 by convention.
    recall = F.coalesce(F.try_divide(F.col("ctp").cast("double"), F.col("_t.p").cast("double")), F.lit(1.0))
    curve = steps.withColumn("_t", _totals(steps)).select(
        F.col(SCORE).alias("threshold"), precision.alias("precision"), recall.alias("recall")
    )
    return curve.withColumn(
        "f1",
        2 * F.col("precision") * F.col("recall")
        / F.greatest(F.col("precision") + F.col("recall"), F.lit(MIN_DENOMINATOR)),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The curve row of the largest F1; ties give the lowest threshold."""
    return curve.orderBy(F.desc("f1"), "threshold").limit(1)


def threshold_metrics(scored: DataFrame, cut: float | Column) -> DataFrame:
    """One row: precision, recall, F1 (0 when undefined) and the 2x2 counts."""
    cut = F.lit(cut) if not isinstance(cut, Column) else cut
    flagged = F.col(SCORE) >= F.col("cut")
    counts = scored.withColumn("cut", cut).agg(
        F.max("cut").alias("threshold"),
        F.count_if(~flagged & ~_positive()).alias("tn"),
        F.count_if(flagged & ~_positive()).alias("fp"),
        F.count_if(~flagged & _positive()).alias("fn"),
        F.count_if(flagged & _positive()).alias("tp"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "threshold",
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "tn", "fp", "fn", "tp",
    )


def roc_auc(steps: DataFrame) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    below = F.sum(F.col("fp").cast("double") * (F.col("ctp") - F.col("tp")) + 0.5 * F.col("fp") * F.col("tp"))
    return steps.agg(
        F.try_divide(below, F.sum("tp").cast("double") * F.sum("fp").cast("double")).alias("roc_auc")
    )


def average_precision(steps: DataFrame) -> DataFrame:
    """Step-wise average precision (no interpolation)."""
    gained = F.sum(F.col("tp").cast("double") * F.col("ctp") / (F.col("ctp") + F.col("cfp")))
    return steps.agg(F.try_divide(gained, F.sum("tp").cast("double")).alias("pr_auc"))


def ranking_metrics(steps: DataFrame) -> DataFrame:
    """Both areas in one pass over the steps: (roc_auc, pr_auc)."""
    tp, fp, ctp, cfp = (F.col(name).cast("double") for name in ("tp", "fp", "ctp", "cfp"))
    return steps.agg(
        F.try_divide(F.sum(fp * (ctp - tp) + 0.5 * fp * tp), F.sum(tp) * F.sum(fp)).alias("roc_auc"),
        F.try_divide(F.sum(tp * ctp / (ctp + cfp)), F.sum(tp)).alias("pr_auc"),
    )


def majority_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Always predict the larger train class: P/R/F1, AUC 0.5, AP of a constant.

    A constant score has one step, so its average precision is the share of
    positives in the test side.
    """
    fraud_wins = train.agg(F.count_if(F.col(LABEL).cast("int") == 1) > F.count_if(F.col(LABEL).cast("int") == 0)).scalar()
    counted = test.withColumn("hit", fraud_wins).agg(
        F.count_if(F.col("hit") & _positive()).alias("tp"),
        F.count_if(F.col("hit") & ~_positive()).alias("fp"),
        F.count_if(~F.col("hit") & _positive()).alias("fn"),
        F.count_if(_positive()).alias("p"),
        F.count("*").alias("n"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.select(
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        F.lit(0.5).alias("roc_auc"),
        safe_ratio(F.col("p"), F.col("n")).alias("pr_auc"),
    )


def evaluation_report(scored: DataFrame, tuned: float) -> DataFrame:
    """One nested row: both areas and the metrics at 0.50 and at the tuned cut."""

    def block(cut: float) -> Column:
        row = threshold_metrics(scored, cut)
        return row.select(
            F.struct(
                F.col("threshold").alias("threshold_value"), "precision", "recall", "f1_score",
                F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"),
            ).alias("m")
        ).scalar()

    return ranking_metrics(score_steps(scored)).select(
        "roc_auc", "pr_auc",
        block(0.5).alias("default_threshold"),
        block(tuned).alias("tuned_threshold"),
    )
