"""Per-provider attributions of the boosted trees, and what is told from them.

Shapley values of a tree ensemble with path-dependent expectations (Lundberg
et al. 2018). One leaf is reached with the product over the features on its
path of "value lies in the leaf's interval" when the feature is known, and of
the covered share when it is not. The Shapley values of such a product follow
from a polynomial with one factor per feature, so all leaves of all trees are
evaluated together on a batch of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.operators.boosting import Forest
from adjudica.operators.model import vectorised

ROWS_PER_CHUNK = 16  # an array of a row block by all leaves then stays in a core's cache

# Sentence formats (feature, value, size), tiers and labels of a narrative.
RAISING_SENTENCE = "+ High Risk Driver: '%s' (value: %s) increased log-odds by +%s"
LOWERING_SENTENCE = "- Mitigating Factor: '%s' (value: %s) reduced log-odds by %s"
RAISING_SHOWN, LOWERING_SHOWN = 4, 2
TIER_ABOVE, TIER_BELOW = "CRITICAL / HIGH", "LOW / MONITORED"
LABEL_TRUE, LABEL_FALSE, LABEL_MISSING = "Fraud", "Non-Fraud", "Unknown"


def _paths(nodes: pd.DataFrame) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
    """Leaves of one tree as (value, feature -> (low, high, covered share))."""
    by_id = {row.id: row for row in nodes.itertuples()}
    leaves, todo = [], [(by_id[0], {})]
    while todo:
        node, path = todo.pop()
        if node.left < 0:
            leaves.append((node.value, path))
            continue
        low, high, share = path.get(node.feature, (-np.inf, np.inf, 1.0))
        for child, bounds in (
            (by_id[node.left], (low, min(high, node.cut))),
            (by_id[node.right], (max(low, node.cut), high)),
        ):
            todo.append((child, {**path, node.feature: (*bounds, share * child.cover / node.cover)}))
    return leaves


def leaf_table(forest: Forest) -> dict[str, np.ndarray]:
    """All leaves of a forest as padded arrays (its size is the model's).

    A padding entry has an unbounded interval and covers everything, which
    makes it a player without influence.
    """
    leaves = [leaf for _, part in forest.nodes.groupby("tree") for leaf in _paths(part)]
    width = max([len(path) for _, path in leaves] + [1])
    count = len(leaves)
    table = {
        "value": np.array([value for value, _ in leaves]),
        "feature": np.zeros((count, width), dtype=np.int64),
        "low": np.full((count, width), -np.inf),
        "high": np.full((count, width), np.inf),
        "share": np.ones((count, width)),
    }
    for row, (_, path) in enumerate(leaves):
        for slot, (feature, (low, high, share)) in enumerate(path.items()):
            for name, entry in zip(("feature", "low", "high", "share"), (feature, low, high, share)):
                table[name][row, slot] = entry
    return table


def expected_log_odds(leaves: dict[str, np.ndarray]) -> float:
    """Log-odds when no feature is known."""
    return float((leaves["value"] * leaves["share"].prod(axis=1)).sum())


def shapley_values(x: np.ndarray, leaves: dict[str, np.ndarray], features: int) -> np.ndarray:
    """Attributions of a block of rows, one column per feature."""
    width = leaves["feature"].shape[1]
    taken = x[:, leaves["feature"]]
    inside = ((taken > leaves["low"]) & (taken <= leaves["high"])).astype(np.float64)
    share = leaves["share"]
    weights = [factorial(s) * factorial(width - 1 - s) / factorial(width) for s in range(width)]
    out = np.zeros((len(x), features))
    for player in range(width):
        # Coefficient s: sum over the sets of s other known features.
        coefficients = [np.ones(inside.shape[:2])]
        for other in range(width):
            if other != player:
                known, unknown = inside[:, :, other], share[:, other]
                grown = [coefficients[0] * unknown]
                for s in range(1, len(coefficients)):
                    grown.append(coefficients[s] * unknown + coefficients[s - 1] * known)
                grown.append(coefficients[-1] * known)
                coefficients = grown
        gain = sum(w * c for w, c in zip(weights, coefficients))
        phi = leaves["value"] * (inside[:, :, player] - share[:, player]) * gain
        placed = np.zeros((len(leaves["value"]), features))
        placed[np.arange(len(placed)), leaves["feature"][:, player]] = 1.0
        out += phi @ placed
    return out


def attributions(forest: Forest, features: DataFrame) -> DataFrame:
    """(provider_id, feature, value, phi) in log-odds, one row per provider and feature.

    The leaves are broadcast, 32 per tree at most; rows are evaluated batch by
    batch on the executors.
    """
    leaves = features.sparkSession.sparkContext.broadcast(leaf_table(forest))
    names = list(forest.features)

    def evaluate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=np.float64).reshape(len(batch), len(names))
            blocks = [
                shapley_values(x[start : start + ROWS_PER_CHUNK], leaves.value, len(names))
                for start in range(0, len(x), ROWS_PER_CHUNK)
            ]
            phi = np.concatenate(blocks) if blocks else np.zeros((0, len(names)))
            yield pd.DataFrame({"provider_id": batch["provider_id"], "x": batch["x"], "phi": list(phi)})

    rows = vectorised(features).select("provider_id", vector_to_array("features").alias("x"))
    evaluated = rows.mapInPandas(evaluate, "provider_id string, x array<double>, phi array<double>")
    name_array = F.array(*[F.lit(name) for name in names])
    return evaluated.select(
        "provider_id",
        F.inline(F.arrays_zip(name_array.alias("feature"), F.col("x").alias("value"), F.col("phi").alias("phi"))),
    ).toDF("provider_id", "feature", "value", "phi")


def global_importance(phi: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, descending."""
    return (
        phi.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )


def top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("mean_abs_shap"), "feature").limit(k)


def top_feature_values(phi: DataFrame, importance: DataFrame, k: int = 15) -> DataFrame:
    """Attribution and value of every provider for the leading features."""
    return phi.join(top_features(importance, k).select("feature"), "feature", "left_semi").select(*phi.columns)


def highest_risk(scores: DataFrame) -> DataFrame:
    """The provider with the largest probability, one row."""
    return scores.orderBy(F.desc("probability"), "provider_id").limit(1)


def _by_size() -> list[Column]:
    return [F.desc(F.abs("phi")), F.asc("feature")]


def contribution_breakdown(phi: DataFrame, shown: int = 10) -> DataFrame:
    """Per provider the largest ``shown - 1`` attributions and the rest summed.

    A provider has one row per feature, so its window holds 33 rows.
    """
    place = F.row_number().over(Window.partitionBy("provider_id").orderBy(*_by_size()))
    placed = phi.withColumn("position", F.least(place, F.lit(shown)))
    grouped = placed.groupBy("provider_id", "position").agg(
        F.sum("phi").alias("phi"), F.count("*").alias("n"), F.min("feature").alias("name")
    )
    rest = F.concat(F.col("n").cast("string"), F.lit(" other features"))
    return grouped.select(
        "provider_id", "position",
        F.when((F.col("position") == shown) & (F.col("n") > 1), rest).otherwise(F.col("name")).alias("feature"),
        "phi",
    )


def _fixed(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def narratives(phi: DataFrame, scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Reasons per provider: up to 4 raising and 2 lowering features.

    ``scores`` is (provider_id, potential_fraud, probability).
    """
    raising = F.col("phi") > 0
    place = F.row_number().over(Window.partitionBy("provider_id", raising).orderBy(*_by_size()))
    told = (
        phi.where(F.col("phi") != 0)
        .withColumn("_raising", raising)
        .withColumn("_place", place)
        .where(F.col("_place") <= F.when(F.col("_raising"), RAISING_SHOWN).otherwise(LOWERING_SHOWN))
    )
    words = [F.col("feature"), _fixed(F.coalesce("value", F.lit(0.0)), 2), _fixed(F.col("phi"), 3)]
    sentence = F.when(F.col("_raising"), F.format_string(RAISING_SENTENCE, *words)).otherwise(
        F.format_string(LOWERING_SENTENCE, *words)
    )
    # At most six sentences per provider.
    ordered = F.sort_array(
        F.collect_list(F.struct((~F.col("_raising")).alias("o"), F.col("_place").alias("p"), sentence.alias("s")))
    )
    reasons = told.groupBy("provider_id").agg(F.transform(ordered, lambda r: r["s"]).alias("decision_rationale"))
    fraud = F.col("potential_fraud")
    label = F.when(fraud, LABEL_TRUE).when(~fraud, LABEL_FALSE).otherwise(LABEL_MISSING)
    return scores.join(reasons, "provider_id", "left").select(
        "provider_id",
        F.bround("probability", 4).alias("predicted_fraud_probability"),
        F.when(F.col("probability") >= threshold, TIER_ABOVE).otherwise(TIER_BELOW).alias("assigned_risk_tier"),
        label.alias("ground_truth_label"),
        F.coalesce("decision_rationale", F.array().cast("array<string>")).alias("decision_rationale"),
    )


def explanation_summary(phi: DataFrame, scores: DataFrame, threshold: float = 0.5, k: int = 10) -> DataFrame:
    """One row: the leading features and the narrative of the riskiest provider."""
    leading = top_features(global_importance(phi), k).agg(
        F.reverse(F.sort_array(F.collect_list(F.struct("mean_abs_shap", "feature")))).alias("f")
    ).scalar()
    case = highest_risk(scores)
    own = phi.join(F.broadcast(case.select("provider_id")), "provider_id", "left_semi")
    return narratives(own, case, threshold).select(
        leading.alias("top_features"), F.struct("*").alias("high_risk_case")
    )
