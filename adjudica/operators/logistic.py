"""Logistic regression by Newton steps, each over one mergeable aggregate of the rows.

A step needs the loss, its gradient and its second derivatives at the present
coefficients. Every partition adds them up for its rows, and the driver adds the
partitions' sums in their order, so the fit repeats exactly. Features are scaled to mean
0 and variance 1; the squared coefficients without the intercept are penalised by half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEPS = 50
TOLERANCE = 1e-9  # of the largest change in a step
COEFFICIENTS = "name string, coefficient double, mean double, scale double"
INTERCEPT = "(intercept)"


@dataclass(frozen=True)
class Logistic:
    """Coefficients of scaled features."""

    features: list[str]
    mean: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray
    intercept: float

    def probability(self) -> Column:
        """An expression over the feature columns."""
        odds = F.lit(self.intercept)
        for name, mean, scale, c in zip(self.features, self.mean.tolist(), self.scale.tolist(), self.coefficients.tolist()):
            odds = odds + (F.col(name) - mean) / scale * c
        return 1 / (1 + F.exp(-odds))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = list(zip([INTERCEPT, *self.features], [self.intercept, *self.coefficients.tolist()], [0.0, *self.mean.tolist()], [1.0, *self.scale.tolist()]))
        spark.createDataFrame(rows, COEFFICIENTS).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Logistic:
        rows = {r["name"]: r for r in spark.read.parquet(path).collect()}
        first = rows.pop(INTERCEPT)
        side = lambda name: np.array([r[name] for r in rows.values()])
        return cls(list(rows), side("mean"), side("scale"), side("coefficient"), first["coefficient"])


def _summed(rows: DataFrame, sums_of) -> np.ndarray:
    """The sums of all partitions of (x, label, weight), added in their order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0.0
        for batch in batches:
            if len(batch):
                total = total + sums_of(np.array(batch["x"].tolist(), np.float64), batch["label"].to_numpy(), batch["weight"].to_numpy())
        if not np.isscalar(total):
            yield pd.DataFrame({"sums": [total]})

    return sum((np.array(r["sums"]) for r in rows.mapInPandas(run, "sums array<double>").collect()), 0.0)


def fit(rows: DataFrame, features: list[str]) -> Logistic:
    """``rows`` has features, label and weight; their partitions should not change from run to run."""
    arrays = rows.select(vector_to_array("features").alias("x"), "label", "weight")
    width = len(features)
    moments = _summed(arrays, lambda x, label, weight: np.concatenate([[len(x)], x.sum(axis=0)]))
    if np.isscalar(moments):
        return Logistic(features, np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    mean = moments[1:] / moments[0]
    scale = np.sqrt(_summed(arrays, lambda x, label, weight: ((x - mean) ** 2).sum(axis=0)) / moments[0])
    scale = np.where(scale > 0, scale, 1.0)
    penalty = np.concatenate([[0.0], np.ones(width)])

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def sums(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
            z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
            odds = z @ beta
            p = 1 / (1 + np.exp(-odds))
            loss = (weight * (np.logaddexp(0, odds) - label * odds)).sum()
            return np.concatenate([[loss], z.T @ (weight * (p - label)), (z.T @ (z * (weight * p * (1 - p))[:, None])).ravel()])

        total = _summed(arrays, sums)
        first, second = total[1 : width + 2], total[width + 2 :].reshape(width + 1, width + 1)
        return total[0] + (penalty * beta**2).sum() / 2, first + penalty * beta, second + np.diag(penalty)

    beta = np.zeros(width + 1)
    loss, gradient, curvature = at(beta)
    for _ in range(STEPS):
        # The small term keeps the system solvable if there is one class only.
        step = np.linalg.solve(curvature + 1e-9 * np.eye(width + 1), gradient)
        there = at(beta - step)
        while there[0] > loss + 1e-9 * abs(loss) and np.abs(step).max() > TOLERANCE:
            step = step / 2
            there = at(beta - step)
        beta, (loss, gradient, curvature) = beta - step, there
        if np.abs(step).max() <= TOLERANCE:
            break
    return Logistic(features, mean, scale, beta[1:], float(beta[0]))
