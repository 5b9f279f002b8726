"""Helpers the operators share: clean inputs, written tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adjudica.session import work_dir

JUDGED = 512  # texts judged at once
BATCH_BYTES = 4 << 20  # of an Arrow batch sent to Python, about
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) and nothing else, so other columns cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its rows are fixed,
    computed once, and do not depend on the executors that made them.

    Its shuffle files go with the write that made them, rather than when the driver
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{spark.sparkContext.applicationId}/llm/{label}-{uuid.uuid4().hex[:12]}"
    with _set(spark, CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends Python at most about BATCH_BYTES at once, or what it is set to if that is less.

    By default a batch has 10,000 rows, whatever their texts take, on both sides of
    every task that runs Python.
    """
    if int(spark.conf.get(BATCHES, str((1 << 31) - 1))) > BATCH_BYTES:
        spark.conf.set(BATCHES, str(BATCH_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column has it."""
    while name in df.columns:
        name += "_"
    return name


def only(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """The texts of these ids, picked before they go to Python while the ids are few; beyond ``most`` all."""
    return docs if ids.count() > most else docs.join(F.broadcast(ids), "doc_id", "left_semi")


def rows_where(df: DataFrame, text_col: str, accepts_of: Callable[[], Callable[[list], np.ndarray]]) -> DataFrame:
    """The rows whose text is accepted, with all their columns and without a shuffle.

    Only the text goes to Python and only the mask comes back. ``accepts_of`` is
    called once in every task and gives a function from a list of texts to a mask.
    """

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        accepts = accepts_of()
        for part in parts:
            masks = [np.asarray(accepts(part.slice(at, JUDGED).to_pylist()), bool) for at in range(0, len(part), JUDGED)]
            yield pa.array(np.concatenate(masks or [np.empty(0, bool)]))

    return df.where(F.arrow_udf(run, "boolean")(F.col(text_col).cast("string")))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def few(df: DataFrame, per_class: int, class_col: str, id_col: str = "doc_id") -> DataFrame:
    """At most ``per_class`` rows of each class, the first ones by a hash of the id.

    A bounded training sample. Each class first keeps the share of the hash range
    that holds about four times as many rows, so the window that picks the rows
    gets a bounded number however many there are. Classes are labels: few.
    """
    sizes = df.groupBy(class_col).agg(F.count("*").alias("_size"))
    share = F.least(F.lit(1.0), (4.0 * per_class + 100) / F.col("_size"))
    place = F.pmod(F.xxhash64(id_col), F.lit(1 << 30))
    near = df.join(F.broadcast(sizes), class_col).where(place <= share * (1 << 30))
    order = Window.partitionBy(class_col).orderBy(place, F.col(id_col))
    return near.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= per_class).select(*df.columns)


def whole_texts(docs: DataFrame, chosen: DataFrame, class_col: str, budget: int) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (doc_id, class; bounded) names, with their whole texts.

    Where the texts of a class take more than ``budget`` bytes together, its longest
    documents are left out, none is cut. Lengths are added up first, so no more text
    than that leaves the scan. If ``docs`` has the class too, it must agree.
    """
    keys = ["doc_id", class_col] if class_col in docs.columns else ["doc_id"]
    chosen = F.broadcast(chosen.select("doc_id", class_col).distinct())
    sizes = docs.join(chosen, keys).groupBy("doc_id", class_col).agg(F.sum(F.octet_length("text")).alias("_bytes"))
    shorter = Window.partitionBy(class_col).orderBy("_bytes", F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    kept = sizes.withColumn("_sum", F.sum("_bytes").over(shorter)).where(F.col("_sum") <= budget).select("doc_id", class_col)
    return docs.join(F.broadcast(kept), keys)


def class_sizes(labels: DataFrame) -> dict[int, int]:
    """Rows of each label 0 and 1 among all labels, for the shares a sample does not have."""
    return {0: 0, 1: 0} | {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}


def _distinct_edges(df: DataFrame, label: str) -> DataFrame:
    return staged(df.where("a > b").distinct(), label)


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every id in the links (a, b); the component is its smallest id.

    Large-star and small-star steps: each points the neighbours of an id at the
    smallest of them, by one min aggregate and one join, so a hub with millions of
    links is reduced before the shuffle and no list of neighbours is ever built.
    The steps repeat until the links are stars; every round is a written table.
    """
    now = _distinct_edges(
        edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")), "edges"
    )

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    seen = digest(now)
    while seen[0]:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a"), F.least("_m", "a").alias("_m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = _distinct_edges(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        now = _distinct_edges(small.union(least.select("a", F.col("_m").alias("b"))), "small")
        then, seen = seen, digest(now)
        if then == seen:
            break
    members = now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component_id"))
    return members.union(now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
