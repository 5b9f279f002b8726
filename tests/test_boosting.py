"""Boosted trees against a plain search over rows, and the same in any layout."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from adjudica.operators import boosting as b
from adjudica.operators.boosting import Forest, Settings

NAMES = ["f0", "f1", "f2", "f3"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        x = [float(rng.integers(0, 6)), float(rng.normal()), float(rng.uniform(0, 100)), 1.0]
        label = float(x[0] + 2 * x[1] + rng.normal() > 3)
        rows.append((f"P{i}", x, label, 3.0 if label else 1.0, i % 3))
    frame = spark.createDataFrame(rows, "provider_id string, x array<double>, label double, weight double, fold int")
    return frame.select("provider_id", array_to_vector("x").alias("features"), "x", "label", "weight", "fold").cache()


def plain_trees(rows, cuts, settings, keys):
    """The same trees by trying every cut of every node over its rows."""
    x, label, weight = (np.array([r[n] for r in rows]) for n in ("x", "label", "weight"))
    margin, out = np.zeros(len(x)), []
    for number, columns in enumerate(b._drawn_columns(settings, len(cuts))):
        used = b._uniform(keys, number) < settings.row_share
        p = 1 / (1 + np.exp(-margin))
        g, h = (np.where(used, np.round(weight * v * b.UNIT) / b.UNIT, 0) for v in (p - label, p * (1 - p)))
        value = np.zeros(len(x))
        nodes = []

        def grow(at, mine, depth):
            G, H = g[mine].sum(), h[mine].sum()
            best = (1e-9, None)
            if depth < settings.depth:
                for f in columns:
                    for cut in cuts[f]:
                        left, right = mine & (x[:, f] <= cut), mine & (x[:, f] > cut)
                        if min(h[left].sum(), h[right].sum()) >= 1:
                            gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right)) - G**2 / (H + 1)
                            if gain > best[0] + 1e-12:
                                best = (gain, (int(f), float(cut), left, right))
            if best[1] is None:
                leaf = np.round(-settings.rate * G / (H + 1) * b.UNIT) / b.UNIT
                value[mine] = leaf
                nodes.append((at, -1, None, leaf))
            else:
                f, cut, left, right = best[1]
                nodes.append((at, f, cut, 0.0))
                grow(2 * at + 1, left, depth + 1)
                grow(2 * at + 2, right, depth + 1)

        grow(0, np.ones(len(x), bool), 0)
        margin = margin + value
        out.append(sorted(nodes))
    return out


def listed(forest):
    found = forest.nodes.replace({np.nan: None})
    return [[(r.id, r.feature, r.cut, r.value) for r in part.itertuples()] for _, part in found.groupby("tree")]


def test_against_a_plain_search(vectors):
    settings = Settings(4, 3, 0.3, 0.8, 0.75, 5)
    rows = vectors.select("x", "label", "weight", F.xxhash64(F.lit(5), "provider_id").alias("k")).collect()
    cuts = b.feature_cuts(vectors)
    keys = np.array([r["k"] for r in rows], np.int64).view(np.uint64)
    got = listed(b.fit_forests(vectors, NAMES, settings)[0])
    want = plain_trees(rows, cuts, settings, keys)
    assert [[n[:2] for n in t] for t in got] == [[n[:2] for n in t] for t in want]
    for one, other in zip(got, want):
        for x, y in zip(one, other):
            assert (x[2] is None) == (y[2] is None) and x[2] == y[2] and abs(x[3] - y[3]) < 1e-9


def test_many_partitions_and_folds_give_the_same(vectors, monkeypatch):
    """One task for each forest, a job for each level, merged by tasks or not, and separate fits."""
    settings = Settings(5, 3, 0.2, 0.85, 0.8, 42)
    cuts = b.feature_cuts(vectors)
    one = [listed(f) for f in b.fit_forests(vectors, NAMES, settings, folds=3, cuts=cuts)]
    monkeypatch.setattr(b, "REFRESH", 2)
    many = [listed(f) for f in b.fit_forests(vectors.repartition(5), NAMES, settings, folds=3, cuts=cuts, rows_per_partition=60)]
    assert one == many and len(one) == 4
    monkeypatch.setattr(b, "MERGED_ON_DRIVER", 1)
    assert listed(b.fit_forests(vectors, NAMES, settings, cuts=cuts, rows_per_partition=60)[0]) == one[3]
    for fold in range(3):
        assert listed(b.fit_forests(vectors.where(F.col("fold") != fold), NAMES, settings, cuts=cuts)[0]) == one[fold]


def test_cuts():
    assert b.place_cuts(np.array([3.0, 1.0, 1.0])).tolist() == [2.0] and b.place_cuts(np.ones(5)).tolist() == []
    cuts = b.place_cuts(np.random.default_rng(0).normal(size=10_000))
    share = np.diff(np.searchsorted(np.sort(np.random.default_rng(0).normal(size=10_000)), [-9, *cuts, 9]))
    assert len(cuts) == b.BINS - 1 and share.max() < 2 * 10_000 / b.BINS
    skewed = np.concatenate([np.zeros(9_000), np.arange(1, 1001)])
    assert 0 < len(b.place_cuts(skewed)) < b.BINS


def test_log_odds_and_round_trip(spark, vectors, tmp_path):
    forest = b.fit_forests(vectors, NAMES, Settings(6, 4, 0.3, 1.0, 1.0, 1))[0]
    x = np.array([r["x"] for r in vectors.collect()])

    def walk(row):
        total = 0.0
        for _, part in forest.nodes.groupby("tree"):
            by_id = {n.id: n for n in part.itertuples()}
            node = by_id[0]
            while node.left >= 0:
                node = by_id[node.left if row[node.feature] <= node.cut else node.right]
            total += node.value
        return total

    assert np.allclose(forest.log_odds(x), [walk(r) for r in x], atol=1e-12)
    forest.save(spark, f"{tmp_path}/trees")
    back = Forest.load(spark, f"{tmp_path}/trees", NAMES)
    pd.testing.assert_frame_equal(back.nodes, forest.nodes, check_dtype=False)
    scored = b.with_probability(forest, vectors.select("provider_id", "features"), "p").collect()
    assert len(scored) == 300 and all(0 < r["p"] < 1 for r in scored)


def test_no_rows(spark, vectors):
    forest = b.fit_forests(vectors.where("false"), NAMES, Settings(3, 3, 0.3, 1.0, 1.0, 1))[0]
    assert forest.nodes.empty and forest.log_odds(np.zeros((2, 4))).tolist() == [0.0, 0.0]
