"""Logistic regression against its optimality conditions, and the same on every run."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector

from adjudica.operators import logistic

NAMES = ["a", "b", "c"]


def rows(spark, parts=3):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(5, 2, 400), rng.uniform(0, 1000, 400), np.full(400, 7.0)])
    label = (x[:, 0] + x[:, 1] / 200 + rng.normal(0, 2, 400) > 8).astype(float)
    weight = np.where(label == 1, 1.5, 0.75)
    data = [(v.tolist(), float(y), float(w), *map(float, v)) for v, y, w in zip(x, label, weight)]
    frame = spark.createDataFrame(data, "x array<double>, label double, weight double, a double, b double, c double").coalesce(1).repartition(parts)
    return frame.withColumn("features", array_to_vector("x")), x, label, weight


def test_optimum(spark, tmp_path):
    frame, x, label, weight = rows(spark)
    model = logistic.fit(frame, NAMES)
    z = (x - x.mean(axis=0)) / np.array([*x.std(axis=0)[:2], 1.0])
    p = 1 / (1 + np.exp(-(z @ model.coefficients + model.intercept)))
    assert np.abs(z.T @ (weight * (p - label)) + model.coefficients).max() < 1e-6
    assert abs((weight * (p - label)).sum()) < 1e-6 and model.coefficients[2] == 0
    model.save(spark, f"{tmp_path}/m")
    back = logistic.Logistic.load(spark, f"{tmp_path}/m")
    assert back.features == NAMES and (back.coefficients == model.coefficients).all() and back.intercept == model.intercept
    scored = frame.select("a", "b", back.probability().alias("p")).collect()
    want = {(float(a), float(b)): q for a, b, q in zip(x[:, 0], x[:, 1], p)}
    assert all(abs(want[r["a"], r["b"]] - r["p"]) < 1e-9 for r in scored)
    again = logistic.fit(frame, NAMES)
    assert (again.coefficients == model.coefficients).all()


def test_one_class_and_no_rows(spark):
    frame, *_ = rows(spark)
    alone = logistic.fit(frame.where("label = 1"), NAMES)
    assert np.isfinite(alone.coefficients).all() and alone.intercept > 2
    none = logistic.fit(frame.where("false"), NAMES)
    assert none.intercept == 0 and none.coefficients.tolist() == [0, 0, 0]
