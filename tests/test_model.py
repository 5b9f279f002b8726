import itertools
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.operators import attribution, model
from adjudica.operators.features import FEATURES
from adjudica.operators.split import split_summary


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        x = rng.uniform(0, 100, len(FEATURES))
        fraud = bool(x[3] + 0.5 * x[14] + rng.normal(0, 15) > 110)
        rows.append((f"P{i}", fraud, *[None if i % 50 == 0 and j == 5 else float(v) for j, v in enumerate(x)]))
    schema = "provider_id string, potential_fraud boolean, " + ", ".join(f"{n} double" for n in FEATURES)
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def trained(features):
    return model.train_and_evaluate(features, rounds=8, folds=2)


@pytest.fixture(scope="module")
def bundle(trained, tmp_path_factory):
    return model.save_bundle(trained, str(tmp_path_factory.mktemp("bundle")))


def test_training_run(trained):
    row = trained.evaluation.first()
    assert 0 <= row["roc_auc"] <= 1 and 0 <= row["pr_auc"] <= 1
    assert sum(sum(r) for r in row["tuned_threshold"]["confusion_matrix"]) == trained.split.where("split = 'test'").count()
    assert row["tuned_threshold"]["threshold_value"] == trained.threshold
    kinds = {r["model"]: r for r in trained.baselines.collect()}
    assert kinds["majority_class"]["roc_auc"] == 0.5 and kinds["logistic_regression"]["roc_auc"] > 0.6
    folds = trained.cross_validation.collect()
    assert len(folds) == 2 and all(0 <= r["roc_auc"] <= 1 for r in folds)
    assert 0 <= model.cv_summary(trained.cross_validation).first()["f1"] <= 1
    sides = {r["split"]: r for r in split_summary(trained.split).collect()}
    share = sides["test"]["providers"] / (sides["test"]["providers"] + sides["train"]["providers"])
    assert 0.15 <= share <= 0.25 and sides["test"]["fraud"] > 0 and sides["train"]["fraud"] > 0
    train = sides["train"]
    assert trained.weight == train["clean"] / max(train["fraud"], 1)


def test_bundle_round_trip(spark, trained, bundle, features):
    back = model.load_bundle(spark, bundle)
    assert back.feature_names == FEATURES and back.threshold == trained.threshold
    assert back.split.count() == 240 and back.metrics.first()["roc_auc"] == trained.evaluation.first()["roc_auc"]
    mine = {r["provider_id"]: r["probability"] for r in model.score(trained.trees, features).collect()}
    again = {r["provider_id"]: r["probability"] for r in model.score(back.trees, features).collect()}
    assert mine == again and all(0 <= p <= 1 for p in mine.values())


def test_attributions_add_up_to_the_log_odds(spark, trained, bundle, features):
    phi = attribution.attributions(trained.trees, features)
    assert phi.count() == 240 * 33
    base = attribution.expected_log_odds(attribution.leaf_table(trained.trees))
    sums = phi.groupBy("provider_id").agg(F.sum("phi").alias("s"))
    scores = model.score(trained.trees, features)
    gap = sums.join(scores, "provider_id").select(
        F.abs(F.col("s") + base - F.log(F.col("probability") / (1 - F.col("probability")))).alias("g")
    )
    assert gap.agg(F.max("g")).first()[0] < 1e-9
    summary = attribution.explanation_summary(phi, scores).first()
    assert len(summary["top_features"]) == 10
    assert summary["high_risk_case"]["provider_id"] == attribution.highest_risk(scores).first()["provider_id"]


def test_blocks_of_rows_by_leaves_stay_small():
    leaves = model.ROUNDS << model.MAX_DEPTH
    assert attribution.ROWS_PER_CHUNK * leaves * 8 <= 1 << 20  # bytes


def test_shapley_values_against_all_subsets():
    rng = np.random.default_rng(0)
    leaves = {
        "value": rng.normal(size=6), "feature": np.array([rng.permutation(5)[:3] for _ in range(6)]),
        "low": rng.uniform(-1, 0.2, (6, 3)), "high": rng.uniform(0.3, 1, (6, 3)), "share": rng.uniform(0.1, 1, (6, 3)),
    }
    # A padded slot repeats a feature without influence.
    leaves["low"][0, 2], leaves["high"][0, 2], leaves["share"][0, 2] = -np.inf, np.inf, 1.0
    x = rng.uniform(-1, 1, (4, 5))

    def worth(row, known):
        total = 0.0
        for leaf in range(6):
            part = leaves["value"][leaf]
            for slot in range(3):
                f = leaves["feature"][leaf, slot]
                inside = leaves["low"][leaf, slot] < row[f] <= leaves["high"][leaf, slot]
                part *= float(inside) if f in known else leaves["share"][leaf, slot]
            total += part
        return total

    got = attribution.shapley_values(x, leaves, 5)
    for i, row in enumerate(x):
        for f in range(5):
            others = [j for j in range(5) if j != f]
            value = sum(
                factorial(k) * factorial(4 - k) / factorial(5) * (worth(row, {*s, f}) - worth(row, set(s)))
                for k in range(5) for s in itertools.combinations(others, k)
            )
            assert abs(got[i, f] - value) < 1e-12


def given(spark):
    phi = spark.createDataFrame(
        [("P1", f"f{i}", 1.5 + i, v) for i, v in enumerate([0.5, -0.25, 0.125, 0.0, 0.75, -1.0, 0.3, -0.1, 0.2, 0.05, 0.01, 0.02])],
        "provider_id string, feature string, value double, phi double",
    )
    scores = spark.createDataFrame([("P1", True, 0.61236), ("P2", None, 0.2)], "provider_id string, potential_fraud boolean, probability double")
    return phi, scores


def test_narrative(spark):
    phi, scores = given(spark)
    told = {r["provider_id"]: r for r in attribution.narratives(phi, scores).collect()}
    assert told["P1"]["decision_rationale"] == [
        "+ High Risk Driver: 'f4' (value: 5.50) increased log-odds by +0.750",
        "+ High Risk Driver: 'f0' (value: 1.50) increased log-odds by +0.500",
        "+ High Risk Driver: 'f6' (value: 7.50) increased log-odds by +0.300",
        "+ High Risk Driver: 'f8' (value: 9.50) increased log-odds by +0.200",
        "- Mitigating Factor: 'f5' (value: 6.50) reduced log-odds by -1.000",
        "- Mitigating Factor: 'f1' (value: 2.50) reduced log-odds by -0.250",
    ]
    assert (told["P1"]["predicted_fraud_probability"], told["P1"]["assigned_risk_tier"], told["P1"]["ground_truth_label"]) == (0.6124, "CRITICAL / HIGH", "Fraud")
    assert (told["P2"]["decision_rationale"], told["P2"]["assigned_risk_tier"], told["P2"]["ground_truth_label"]) == ([], "LOW / MONITORED", "Unknown")


def test_breakdown_and_importance(spark):
    phi, _ = given(spark)
    parts = {r["position"]: (r["feature"], r["phi"]) for r in attribution.contribution_breakdown(phi).collect()}
    assert len(parts) == 10 and parts[1] == ("f5", -1.0) and parts[10][0] == "3 other features"
    assert abs(sum(p for _, p in parts.values()) - phi.agg(F.sum("phi")).first()[0]) < 1e-12
    importance = attribution.global_importance(phi)
    assert [r["feature"] for r in attribution.top_features(importance, 2).collect()] == ["f5", "f4"]
    assert attribution.top_feature_values(phi, importance, 2).count() == 2


def test_fit_does_not_depend_on_the_layout(features):
    weight = model.positive_weight(features)
    found = []
    for parts in (3, 7):
        trees = model.fit_trees(features.repartition(parts), weight, rounds=5)
        found.append({r["provider_id"]: r["probability"] for r in model.score(trees, features).collect()})
    assert found[0] == found[1]
