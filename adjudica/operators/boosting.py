"""Gradient-boosted trees grown from mergeable histograms.

Features are cut into bins once. A tree grows level by level; a level is one Spark
job: every partition adds up, for each open node, feature and bin, the gradients and
second derivatives of the logistic loss, and the driver, which sees only these sums,
picks the splits. Several forests (one for each fold and one for all rows) grow in the
same jobs, with the forest as one more key of the histograms. Where all rows are one
partition, which a documented number of rows bounds, nothing has to be merged: then the
same steps run in one task for each forest, without a job for each level.

Gradients and leaf values are rounded to whole units of 2^-24 before they are added, so a
sum is exact and the same for any partitioning and any order. Rows and columns are sampled by hashes
of the provider's id and of the round. The model is therefore the same for any layout.

The rows stay in one cached RDD of NumPy blocks with their margins: each of the some
900 jobs of a fit touches every row a few times, and a DataFrame would be planned and
sent through Arrow anew for each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions.ordering import hash_order
from adjudica.session import work_dir

BINS = 64
SAMPLE_ROWS = 20_000  # rows whose values place the cuts, the first by md5 of the id
UNIT = 1 << 24
LEAST_HESSIAN = 1.0  # in a child
PENALTY = 1.0  # on the square of a leaf's value
REFRESH = 20  # rounds after which the margins are brought up to date and written
MERGED_ON_DRIVER = 16  # partitions; the sums of more are merged by tasks first
NODES = "tree int, id int, left int, right int, feature int, cut double, value double, cover double"


@dataclass(frozen=True)
class Settings:
    rounds: int
    depth: int
    rate: float
    row_share: float
    column_share: float
    seed: int


@dataclass(frozen=True)
class Forest:
    """A node table: ``left`` is -1 at a leaf, whose ``value`` counts in the log-odds;
    a row goes left if its feature is at most ``cut``; ``cover`` is the sum of second derivatives."""

    nodes: pd.DataFrame
    features: list[str]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODES).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: list[str]) -> Forest:
        return cls(spark.read.parquet(path).orderBy("tree", "id").toPandas(), features)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """The sum of the leaves each row of features reaches, all trees side by side."""
        if self.nodes.empty:
            return np.zeros(len(x))
        place = {key: at for at, key in enumerate(zip(self.nodes["tree"], self.nodes["id"]))}
        tree, left, right = (self.nodes[c].to_numpy() for c in ("tree", "left", "right"))
        down = [np.array([place.get((t, c), at) for at, (t, c) in enumerate(zip(tree, side))]) for side in (left, right)]
        feature, cut, inner = np.maximum(self.nodes["feature"].to_numpy(), 0), self.nodes["cut"].to_numpy(), left >= 0
        at = np.tile([place[t, 0] for t in np.unique(tree)], (len(x), 1))
        rows = np.arange(len(x))[:, None]
        while inner[at].any():
            goes_left = x[rows, feature[at]] <= cut[at]
            at = np.where(goes_left, down[0][at], down[1][at])  # a leaf leads to itself
        return self.nodes["value"].to_numpy()[at].sum(axis=1)


def with_probability(forest: Forest, vectors: DataFrame, out: str) -> DataFrame:
    """Adds the probability of the flagged class; the node table is sent to the tasks."""
    nodes = vectors.sparkSession.sparkContext.broadcast((forest.nodes, forest.features))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent = Forest(*nodes.value)
        for batch in batches:
            x = np.array(batch["_x"].tolist(), np.float64).reshape(len(batch), len(sent.features))
            batch[out] = 1.0 / (1.0 + np.exp(-sent.log_odds(x)))
            yield batch.drop(columns="_x")

    kept = [c for c in vectors.columns if c not in ("features", out)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.select(kept).schema.fields)
    rows = vectors.select(*kept, vector_to_array("features").alias("_x"))
    return rows.mapInPandas(score, f"{schema}, `{out}` double")


def place_cuts(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins - 1`` cuts of a feature, halfway between neighbouring values."""
    known, counts = np.unique(values, return_counts=True)
    if len(known) <= bins:
        return (known[1:] + known[:-1]) / 2
    share = np.cumsum(counts)[:-1] / len(values)
    at = np.unique(np.searchsorted(share, np.arange(1, bins) / bins))
    at = at[at < len(known) - 1]
    return (known[at] + known[at + 1]) / 2


def feature_cuts(vectors: DataFrame, id_col: str = "provider_id") -> list[np.ndarray]:
    """Cuts of every feature, from at most SAMPLE_ROWS rows."""
    rows = vectors.select(vector_to_array("features").alias("x"), hash_order(id_col).alias("o"), id_col).orderBy("o", id_col).limit(SAMPLE_ROWS)
    x = np.array([r["x"] for r in rows.collect()], np.float64)
    return [place_cuts(x[:, k]) for k in range(x.shape[1])] if len(x) else []


def _uniform(keys: np.ndarray, number: int) -> np.ndarray:
    """A number in [0, 1) for each key and round, by hashing."""
    with np.errstate(over="ignore"):
        mixed = keys + np.uint64((number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ mixed >> np.uint64(shift)) * np.uint64(factor)
    return (mixed ^ mixed >> np.uint64(31)) / 2.0**64


@dataclass
class _Block:
    """Rows of a partition: hashed ids, label, weight, fold, bins and a margin for each forest."""

    key: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    bins: np.ndarray
    margin: np.ndarray


@dataclass
class _Tree:
    """A tree in heap order: the children of node i are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray  # -1 where a row stays
    bin: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> _Tree:
        size = (1 << depth + 1) - 1
        return cls(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size))


def _reached(trees: list[_Tree], bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row (first axis) in each tree after ``depth`` steps."""
    feature, cut = np.array([t.feature for t in trees]), np.array([t.bin for t in trees])
    rows, tree = np.arange(len(bins))[:, None], np.arange(len(trees))[None, :]
    node = np.zeros((len(bins), len(trees)), np.int64)
    for _ in range(depth):
        f = feature[tree, node]
        right = bins[rows, np.maximum(f, 0)] > cut[tree, node]
        node = np.where(f >= 0, 2 * node + 1 + right, node)
    return node


def _margins(block: _Block, done: list[list[_Tree]], depth: int) -> np.ndarray:
    """Margins by forest, with the trees grown since they were brought up to date."""
    margin = block.margin.copy()
    for k, trees in enumerate(done):
        if trees:
            node = _reached(trees, block.bins, depth)
            margin[k] += np.array([t.value for t in trees])[np.arange(len(trees))[None, :], node].sum(axis=1)
    return margin


def _histograms(block: _Block, margin: np.ndarray, forests: list[int], growing: list[_Tree], level: int, number: int, columns: np.ndarray, settings: Settings) -> np.ndarray:
    """Sums (forest, node of the level, column, bin, gradient or second derivative) in units.

    Forest k has the rows whose fold is not k.
    """
    width, first = 1 << level, (1 << level) - 1
    total = np.zeros((len(growing), width, len(columns), BINS, 2))
    sampled = _uniform(block.key, number) < settings.row_share
    bins = block.bins[:, columns].astype(np.int64)
    for place, (k, tree) in enumerate(zip(forests, growing)):
        node = _reached([tree], block.bins, level)[:, 0] - first
        rows = np.flatnonzero(sampled & (block.fold != k) & (node >= 0))
        p = 1.0 / (1.0 + np.exp(-margin[place, rows]))
        sums = [np.round(block.weight[rows] * v * UNIT) for v in (p - block.label[rows], p * (1 - p))]
        cell = (node[rows, None] * len(columns) + np.arange(len(columns))) * BINS + bins[rows]
        for side, values in enumerate(sums):
            added = np.bincount(cell.ravel(), np.repeat(values, len(columns)), width * len(columns) * BINS)
            total[place, ..., side] = added.reshape(width, len(columns), BINS)
    return total


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, column and bin of each node's best split; of equal ones the first column and bin.

    ``sums`` is (node, column, bin, gradient or second derivative). The gain is 0 where
    no split helps.
    """
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums.sum(axis=2)[:, :, None]
    right = whole - left

    def weight(part: np.ndarray) -> np.ndarray:
        return part[..., 0] ** 2 / (part[..., 1] + PENALTY)

    gain = weight(left) + weight(right) - weight(whole)
    gain[(left[..., 1] < LEAST_HESSIAN) | (right[..., 1] < LEAST_HESSIAN)] = 0
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    return flat[np.arange(len(flat)), at], at // gain.shape[2], at % gain.shape[2]


def _leaf(total: np.ndarray, rate: float) -> float:
    """The value of a leaf in whole units."""
    return float(np.round(-rate * total[0] / (total[1] + PENALTY) * UNIT) / UNIT)


def _grow(tree: _Tree, level: int, sums: np.ndarray, columns: np.ndarray, rate: float) -> bool:
    """Splits the nodes of a level; whether any node was split."""
    first = (1 << level) - 1
    exact = sums / UNIT
    gain, column, cut = best_splits(exact)
    left = np.cumsum(exact, axis=2)
    for node in range(1 << level):
        own = exact[node, 0].sum(axis=0)
        if level == 0:
            tree.cover[0], tree.value[0] = own[1], _leaf(own, rate)
        if gain[node] <= 1e-9:
            continue
        at = first + node
        tree.feature[at], tree.bin[at] = columns[column[node]], cut[node]
        part = left[node, column[node], cut[node]]
        for child, total in ((2 * at + 1, part), (2 * at + 2, own - part)):
            tree.cover[child], tree.value[child] = total[1], _leaf(total, rate)
    return bool((gain > 1e-9).any())


def _round(sums_of: Callable[[list[_Tree], int], np.ndarray], forests: int, columns: np.ndarray, settings: Settings) -> list[_Tree]:
    """One tree for each forest, from the sums of their levels."""
    growing = [_Tree.empty(settings.depth) for _ in range(forests)]
    for level in range(settings.depth):
        total = sums_of(growing, level)
        if not any([_grow(tree, level, total[k], columns, settings.rate) for k, tree in enumerate(growing)]):
            break
    return growing


def _drawn_columns(settings: Settings, count: int) -> list[np.ndarray]:
    """The columns of every round."""
    draw = np.random.default_rng(settings.seed)
    width = max(1, round(settings.column_share * count))
    return [np.sort(draw.permutation(count)[:width]) for _ in range(settings.rounds)]


def _whole_forest(block: _Block, forest: int, settings: Settings) -> list[_Tree]:
    """All trees of a forest whose rows are one block."""
    margin, trees = block.margin[:1].copy(), []
    for number, columns in enumerate(_drawn_columns(settings, block.bins.shape[1])):
        sums_of = lambda growing, level: _histograms(block, margin, [forest], growing, level, number, columns, settings)  # noqa: B023, E731
        trees += _round(sums_of, 1, columns, settings)
        margin[0] += trees[-1].value[_reached(trees[-1:], block.bins, settings.depth)[:, 0]]
    return trees


def _node_table(trees: list[_Tree], cuts: list[np.ndarray]) -> pd.DataFrame:
    rows = []
    for number, tree in enumerate(trees):
        todo = [0]
        while todo:
            at = todo.pop(0)
            f = int(tree.feature[at])
            if f < 0:
                rows.append((number, at, -1, -1, -1, None, float(tree.value[at]), float(tree.cover[at])))
            else:
                rows.append((number, at, 2 * at + 1, 2 * at + 2, f, float(cuts[f][tree.bin[at]]), 0.0, float(tree.cover[at])))
                todo += [2 * at + 1, 2 * at + 2]
    names = ["tree", "id", "left", "right", "feature", "cut", "value", "cover"]
    kinds = {n: "int32" for n in names[:5]} | {n: "float64" for n in names[5:]}
    return pd.DataFrame(rows, columns=names).astype(kinds).sort_values(["tree", "id"], ignore_index=True)


def fit_forests(
    vectors: DataFrame, features: list[str], settings: Settings, folds: int = 0, cuts: list[np.ndarray] | None = None,
    rows_per_partition: int = 50_000,
) -> list[Forest]:
    """One forest for each fold, fitted on the rows of the others, then one on all rows.

    ``vectors`` has provider_id, features, label, weight and, with ``folds``, fold.
    Without rows or cuts the forests are empty.
    """
    spark = vectors.sparkSession
    work_dir(spark)
    fold = F.col("fold") if folds else F.lit(-1)
    rows = vectors.select("provider_id", "features", "label", "weight", fold.cast("int").alias("fold"))
    cuts = feature_cuts(rows) if cuts is None else cuts
    if not any(len(c) for c in cuts):
        return [Forest(_node_table([], cuts), features) for _ in range(folds + 1)]
    partitions = max(1, -(-rows.count() // rows_per_partition))
    forests, depth = folds + 1, settings.depth

    def blocks(found: Iterator) -> Iterator[_Block]:
        part = list(found)
        if part:
            x = np.array([r["x"] for r in part], np.float64)
            bins = np.column_stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)]).astype(np.uint8)
            side = lambda name, kind: np.array([r[name] for r in part], kind)
            key = side("key", np.int64).view(np.uint64)
            yield _Block(key, side("label", float), side("weight", float), side("fold", np.int64), bins, np.zeros((forests, len(part))))

    # The hashes that sample a row follow from its id.
    key = F.xxhash64(F.lit(settings.seed), "provider_id").alias("key")
    dealt = rows.select(key, vector_to_array("features").alias("x"), "label", "weight", "fold").repartition(partitions, "key")
    data = dealt.rdd.mapPartitions(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    if partitions == 1:
        each = data.flatMap(lambda block: [(k, block) for k in range(forests)])
        each = each.partitionBy(forests, int) if forests > 1 else each
        found = dict(each.map(lambda pair: (pair[0], _whole_forest(pair[1], pair[0], settings))).collect())
        data.unpersist()
        return [Forest(_node_table(found.get(k, []), cuts), features) for k in range(forests)]
    grown: list[list[_Tree]] = [[] for _ in range(forests)]
    fresh: list[list[_Tree]] = [[] for _ in range(forests)]
    for number, columns in enumerate(_drawn_columns(settings, len(cuts))):

        def sums_of(growing: list[_Tree], level: int) -> np.ndarray:
            state = (list(range(forests)), growing, level, number, columns, settings)  # noqa: B023
            done = fresh  # noqa: B023
            sums = data.map(lambda block: _histograms(block, _margins(block, done, depth), *state))  # noqa: B023
            return sums.treeReduce(np.add) if partitions > MERGED_ON_DRIVER else sum(sums.collect())

        for k, tree in enumerate(_round(sums_of, forests, columns, settings)):
            grown[k].append(tree)
            fresh[k].append(tree)
        if number % REFRESH == REFRESH - 1 and number < settings.rounds - 1:
            done = fresh
            brought = data.map(lambda block, done=done: _Block(block.key, block.label, block.weight, block.fold, block.bins, _margins(block, done, depth)))
            brought.persist(StorageLevel.MEMORY_AND_DISK).checkpoint()
            brought.count()
            data.unpersist()
            data, fresh = brought, [[] for _ in range(forests)]
    data.unpersist()
    return [Forest(_node_table(trees, cuts), features) for trees in grown]
