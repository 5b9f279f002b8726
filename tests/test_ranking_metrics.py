import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.operators import metrics, ranking, split


def test_hash_rank_follows_md5_inside_each_group(spark):
    rows = [(f"P{i}", {0: None, 1: True}.get(i % 7, False)) for i in range(2000)]
    df = spark.createDataFrame(rows, "provider_id string, flag boolean")
    got = {r["provider_id"]: r["hash_rank"] for r in ranking.hash_ranked(df, "provider_id", "flag").collect()}
    for flag in (None, True, False):
        keys = sorted((k for k, f in rows if f is flag), key=lambda k: hashlib.md5(f"42|{k}".encode()).hexdigest())
        assert [got[k] for k in keys] == list(range(1, len(keys) + 1))


def test_running_totals_with_a_hot_value(spark):
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(50), i, rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "v int, k int, w int")
    got = {r["k"]: (r["n"], r["s"]) for r in ranking.running_totals(df, [F.desc("v"), F.asc("k")], {"n": F.lit(1), "s": F.col("w")}).collect()}
    total = 0
    for place, (_, k, w) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1):
        total += w
        assert got[k] == (place, total)


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "v int")
    assert ranking.global_row_number(df, [F.asc("v")], "n").count() == 0


@pytest.mark.parametrize("n", [1, 7, 10, 23, 100])
def test_ntile_closed_form(spark, n):
    df = spark.range(1, n + 1).selectExpr("id", "ntile(10) OVER (ORDER BY id) AS expected", f"{n}L AS n")
    wrong = df.where(ranking.ntile_bucket(F.col("id"), F.col("n"), 10) != F.col("expected"))
    assert wrong.count() == 0


def scored(spark, seed, n=400, distinct=60):
    rng = random.Random(seed)
    rows = [(rng.randrange(distinct) / distinct, int(rng.random() < 0.3)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "score double, label int")


def test_areas_against_pairs(spark):
    rows, df = scored(spark, 5)
    steps = metrics.score_steps(df)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    order = sorted({s for s, _ in rows}, reverse=True)
    ap, before = 0.0, 0
    for s in order:
        taken = [y for score, y in rows if score >= s]
        ap += (sum(taken) - before) / len(pos) * (sum(taken) / len(taken))
        before = sum(taken)
    both = metrics.ranking_metrics(steps).first()
    assert abs(both["roc_auc"] - auc) < 1e-12 and abs(both["pr_auc"] - ap) < 1e-12
    assert abs(metrics.roc_auc(steps).first()[0] - auc) < 1e-12
    assert abs(metrics.average_precision(steps).first()[0] - ap) < 1e-12


def test_curve_and_best_cut(spark):
    rows, df = scored(spark, 8)
    curve = {r["threshold"]: r for r in metrics.pr_curve(df).collect()}
    best = None
    for cut in sorted(curve):
        tp = sum(y for s, y in rows if s >= cut)
        fp = sum(1 - y for s, y in rows if s >= cut)
        precision, recall = tp / (tp + fp), tp / sum(y for _, y in rows)
        f1 = 2 * precision * recall / max(precision + recall, 1e-9)
        assert abs(curve[cut]["precision"] - precision) < 1e-12 and abs(curve[cut]["f1"] - f1) < 1e-12
        if best is None or f1 > best[0]:
            best = (f1, cut)
    assert metrics.best_threshold(metrics.pr_curve(df)).first()["threshold"] == best[1]


def test_threshold_counts_and_empty_cells(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.4, 1), (0.1, 0)], "score double, label int")
    row = metrics.threshold_metrics(df, 0.5).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 1, 1, 1) and row["f1_score"] == 0.5
    none = metrics.threshold_metrics(df, 2.0).first()
    assert (none["precision"], none["recall"], none["f1_score"]) == (0.0, 0.0, 0.0)
    one_class = df.where("label = 0")
    assert metrics.ranking_metrics(metrics.score_steps(one_class)).first()["roc_auc"] is None


def test_majority_baseline(spark):
    side = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    row = metrics.majority_baseline(side, side).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["roc_auc"], row["pr_auc"]) == (0.0, 0.0, 0.0, 0.5, 0.25)
    flipped = spark.createDataFrame([(1,), (1,), (0,)], "label int")
    assert metrics.majority_baseline(flipped, side).first()["recall"] == 1.0


@pytest.mark.parametrize("n,every", [(300, 8), (203, 10), (20, 19)])
def test_split_and_folds(spark, n, every):
    df = spark.createDataFrame([(f"P{i}", i % every == 0) for i in range(n)], "provider_id string, potential_fraud boolean")
    parts = split.assert_disjoint(split.group_split(df))
    counts = {(r["split"], r["potential_fraud"]): r["count"] for r in parts.groupBy("split", "potential_fraud").count().collect()}
    fraud = sum(i % every == 0 for i in range(n))
    assert counts[("test", True)] == max(1, int(fraud * 0.2)) and counts[("test", False)] == max(1, int((n - fraud) * 0.2))
    assert sum(counts.values()) == n
    train = parts.where("split = 'train'")
    weight = split.class_weight(train).first()
    assert weight["scale_pos_weight"] == weight["negatives"] / max(weight["positives"], 1)
    sizes = [r["count"] for r in split.fold_assignment(train).groupBy("potential_fraud", "fold").count().collect()]
    by_class = {f: [r["count"] for r in split.fold_assignment(train).where(F.col("potential_fraud") == f).groupBy("fold").count().collect()] for f in (True, False)}
    assert sum(sizes) == train.count() and all(max(v) - min(v) <= 1 for v in by_class.values())


def test_overlap_is_refused(spark):
    both = spark.createDataFrame([("P1", "train"), ("P1", "test")], "provider_id string, split string")
    with pytest.raises(ValueError):
        split.assert_disjoint(both)
