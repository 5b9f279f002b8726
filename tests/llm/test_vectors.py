"""Near-duplicate embeddings and nearest neighbours against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from adjudica.llm import embedding_dedup, neighbours
from adjudica.llm.common import components

SCHEMA = "vec_id long, embedding array<{}>, dim string"


def rows_of(kind="float"):
    random = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(random.standard_normal((150, 24)))
    centre = unit(random.standard_normal(24))
    tight = centre + 0.02 * random.standard_normal((60, 24))  # one ball
    wide = centre + 0.09 * random.standard_normal((40, 24))  # some linked with it, some not
    pairs = base[:20] + 0.05 * random.standard_normal((20, 24))
    found = [v.astype(np.float32).tolist() for v in np.concatenate([base, tight, wide, pairs, base[:15], 3 * base[:5]])]
    rows = list(enumerate(found))
    rows += [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [1.0, None] * 12), (904, [float("inf")] * 24), (905, [])]
    rows += [(906, [1.0, 2.0]), (907, [1.0, 2.0]), (907, [1.0, 2.0]), (908, [2.0, -1.0]), (None, found[0])]
    return [(i, v, "x") for i, v in rows]


def usable(rows):
    return [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links(spark, kind):
    rows = rows_of()
    good = usable(rows)
    links, parent = {}, {i: i for i, _, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(good):
        for m, (j, b) in enumerate(good):
            if n != m and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9:
                links[n] = links.get(n, 0) + 1
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    most = {}
    for n, (i, _) in enumerate(good):
        most[i] = max(most.get(i, 0), links.get(n, 0))
    df = spark.createDataFrame(rows, SCHEMA.format(kind))
    found = embedding_dedup.near_duplicates(df, recall=0.9999).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (most.get(r.vec_id, 0), root(r.vec_id), root(r.vec_id) == r.vec_id), r
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_nearest(spark):
    rows = rows_of()
    good = list({i: (i, v) for i, v in usable(rows)}.values())
    df = spark.createDataFrame(rows, SCHEMA.format("float"))
    found = {}
    for r in neighbours.nearest(df, nearest_count=20, every=10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    asked = [(i, v) for i, v in good if i % 10 == 0]
    assert set(found) == {i for i, _ in asked if len([1 for _, w in good if len(w) == len(dict(good)[i])]) > 1}
    hit = total = 0
    for i, v in asked:
        best = sorted((-float(v @ w), j) for j, w in good if j != i and len(w) == len(v))[:20]
        assert [rank for rank, _, _ in found[i]] == list(range(1, len(found[i]) + 1)) and len(found[i]) == len(best)
        assert [(-s, j) for _, j, s in found[i]] == sorted((-s, j) for _, j, s in found[i])
        assert all(abs(s - float(v @ dict(good)[j])) < 1e-9 for _, j, s in found[i])
        hit += sum(s >= -best[-1][0] - 1e-9 for _, _, s in found[i])
        total += len(best)
    assert hit / total >= 0.97
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_components(spark):
    random = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(60)] + [(1000, int(j)) for j in range(1001, 1200)] + [(int(a), int(b)) for a, b in random.integers(2000, 2300, (160, 2))]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.id, r.component_id) for r in found} == {(x, root(x)) for x in linked} and len(found) == len(linked)
