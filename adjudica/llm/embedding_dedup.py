"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are normalised, so a cosine of at least t is a distance of at most
sqrt(2 - 2t). Each of several tables projects them on random Gaussian directions,
cuts every projection into steps of one width, and buckets the vectors by the
steps. Vectors that share a bucket are candidates; those whose sign sketches
differ too much are skipped (a chance of 1e-7 for a true link), and all others
are checked by their exact cosine.

Equal vectors are one class from the start. Vectors within half the angle of one
centre are a ball: all of them link with each other, by the triangle inequality,
so a ball's links are counted without making its pairs. Only vectors of different
balls are compared one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import components, staged
from adjudica.llm.vectors import classes, matrix, packed

LEAST_COSINE = 0.9
RECALL = 0.99  # of links right at the least cosine; those above it are found more surely
WIDTH = 2.0  # of a step
BALL_TABLES = 8  # tables that look for balls
SKETCH_WORDS = 2  # 64 signs each
SEED = 20


def same_step(distance: float, width: float = WIDTH) -> float:
    """Chance that two points so far apart fall into the same step."""
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(rows: int, least: float = LEAST_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Projections of a table, so that a vector meets about one unrelated vector in
    it, and the number of tables that give the recall."""
    near, far = same_step(math.sqrt(2 - 2 * least)), same_step(math.sqrt(2))
    projections = max(4, math.ceil(math.log(max(rows, 2)) / -math.log(far)))
    return projections, math.ceil(math.log(1 - recall) / math.log(1 - near**projections))


def _hashed(rows: DataFrame, kind: str, projections: int, tables: int) -> DataFrame:
    """(k, dim, t, bucket, s0, s1): the bucket of every vector in every table, and its sign sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in drawn:
                    random = np.random.default_rng([SEED, dim])
                    drawn[dim] = (
                        random.standard_normal((dim, projections * tables)), random.uniform(0, WIDTH, projections * tables),
                        random.standard_normal((dim, 64 * SKETCH_WORDS)), random.integers(1, 1 << 63, projections, dtype=np.int64) | 1,
                    )
                lines, shifts, signs, mix = drawn[dim]
                of = np.flatnonzero(dims == dim)
                for at in range(0, len(of), 512):
                    part = of[at : at + 512]
                    x = matrix(batch["vec"].take(pa.array(part)).to_pylist(), kind)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    steps = np.floor((x @ lines + shifts) / WIDTH).astype(np.int64).reshape(len(x), tables, projections)
                    with np.errstate(over="ignore"):
                        buckets = (steps * mix).sum(2)
                        buckets = (buckets ^ buckets >> 29) * np.int64(0x1B873593CC9E2D51)
                    sketch = np.packbits(x @ signs > 0, axis=1).view(">i8").astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(batch["k"].to_numpy()[part], tables)), pa.array(np.full(len(x) * tables, dim), pa.int32()),
                            pa.array(np.tile(np.arange(tables), len(x)), pa.int32()), pa.array(buckets.ravel()),
                            *[pa.array(np.repeat(sketch[:, i], tables)) for i in range(SKETCH_WORDS)],
                        ],
                        names=["k", "dim", "t", "bucket", *[f"s{i}" for i in range(SKETCH_WORDS)]],
                    )

    return rows.select("k", "dim", "vec").mapInArrow(run, "k long, dim int, t int, bucket long, s0 long, s1 long")


def _sketches_near(least: float) -> Column:
    bits = 64 * SKETCH_WORDS
    share = math.acos(least) / math.pi
    most = math.ceil(bits * share + 5.3 * math.sqrt(bits * share * (1 - share)))
    differ = sum(F.bit_count(F.col(f"s{i}x").bitwiseXOR(F.col(f"s{i}y"))) for i in range(SKETCH_WORDS))
    return differ <= most


def _cosines(pairs: DataFrame, rows: DataFrame, kind: str) -> DataFrame:
    """The pairs (x, y) with the exact cosine, in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = matrix(batch["vx"].to_pylist(), kind), matrix(batch["vy"].to_pylist(), kind)
                cosine = np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
                yield pa.RecordBatch.from_arrays([batch["x"], batch["y"], pa.array(cosine)], names=["x", "y", "cosine"])

    joined = pairs.join(rows.select(F.col("k").alias("x"), F.col("vec").alias("vx"), F.col("dim").alias("_d")), "x").join(
        rows.select(F.col("k").alias("y"), F.col("vec").alias("vy")), "y"
    )
    # Vectors of one length only meet, but a batch may hold several lengths.
    return joined.select("x", "y", "vx", "vy", "_d").mapInArrow(_by_length(run), "x long, y long, cosine double")


def _by_length(run):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch["_d"].to_numpy()
            for length in np.unique(lengths):
                yield from run(iter([batch.take(pa.array(np.flatnonzero(lengths == length)))]))

    return each


def near_duplicates(
    df: DataFrame, least: float = LEAST_COSINE, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Links are pairs found with a cosine of at least ``least``; a component's id is
    the smallest id links reach, and its row is kept. Null, empty and zero vectors
    and those with null or non-finite components have no links, vectors of
    different lengths neither. Repeated rows stay and link with each other. A null
    id has no links, a null component, and is kept.
    """
    usable, kind = packed(df, id_col, vec_col)
    usable = staged(usable, "vectors")
    rows = staged(classes(usable), "vector-classes")
    projections, tables = table_plan(rows.count(), least, recall)
    hashed = staged(_hashed(rows, kind, projections, tables), "vector-buckets")
    near = _sketches_near(least)

    def side(entries: DataFrame, name: str) -> DataFrame:
        return entries.select("dim", "t", "bucket", *[F.col(c).alias(f"{'' if c == 'k' else c}{name}") for c in entries.columns if c not in ("dim", "t", "bucket")])

    # Balls: each vector with the first one of its bucket; what these links connect, with its first one.
    half = math.cos(math.acos(least) / 2 - 1e-9)
    few = hashed.where(F.col("t") < BALL_TABLES)
    first = few.groupBy("dim", "t", "bucket").agg(F.min(F.struct("k", "s0", "s1")).alias("c"), F.count("*").alias("m")).where("m > 1")
    first = first.select("dim", "t", "bucket", F.col("c.k").alias("y"), F.col("c.s0").alias("s0y"), F.col("c.s1").alias("s1y"))
    star = side(few, "x").join(first, ["dim", "t", "bucket"]).where("x <> y").where(near).select("x", "y").distinct()
    close = _cosines(star, rows, kind).where(F.col("cosine") >= half)
    groups = components(close.select(F.col("x").alias("a"), F.col("y").alias("b")))
    centred = _cosines(groups.where("id <> component_id").select(F.col("id").alias("x"), F.col("component_id").alias("y")), rows, kind)
    balls = centred.where(F.col("cosine") >= half).select(F.col("x").alias("k"), F.col("y").alias("ball"))
    balls = staged(rows.select("k", "size").join(balls, "k", "left").select("k", "size", F.coalesce("ball", "k").alias("ball")), "vector-balls")

    # Pairs across balls. In a bucket, the largest ball stands on one side only.
    entries = hashed.join(balls.select("k", F.col("ball").alias("g")), "k")
    met = entries.groupBy("dim", "t", "bucket", "g").agg(F.count("*").alias("m"))
    met = met.groupBy("dim", "t", "bucket").agg(F.max(F.struct("m", "g")).getField("g").alias("main"), F.count("*").alias("n")).where("n > 1")
    entries = entries.join(met.drop("n"), ["dim", "t", "bucket"])
    outside = side(entries.where("g <> main").drop("main"), "x")
    met = outside.join(side(entries.drop("main"), "y"), ["dim", "t", "bucket"]).where("gx <> gy").where(near)
    across = met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    links = staged(_cosines(across, rows, kind).where(F.col("cosine") >= least).select("x", "y"), "vector-links")

    # A vector's links: its ball without itself, and the members of the classes across.
    sizes = balls.groupBy("ball").agg(F.sum("size").alias("whole"))
    both = links.union(links.select("y", "x"))
    more = both.join(rows.select(F.col("k").alias("y"), "size"), "y").groupBy(F.col("x").alias("k")).agg(F.sum("size").alias("more"))
    counted = balls.join(sizes, "ball").join(more, "k", "left")
    counted = counted.select("k", (F.col("whole") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links"))
    inside = balls.where("k <> ball").select(F.col("k").alias("a"), F.col("ball").alias("b"))
    whole = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")).union(inside))
    found = counted.join(whole.withColumnRenamed("id", "k"), "k", "left").select("k", "n_links", F.coalesce("component_id", "k").alias("component_id"))

    members = usable.select("vec_id", "digest").join(rows.select("digest", "k"), "digest").join(found, "k")
    members = members.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    every = df.select(F.col(id_col).cast("long").alias("vec_id")).join(members, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return every.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
