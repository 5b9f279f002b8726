"""Row numbers and running totals that no single task has to hold.

A window without PARTITION BY, or with a two-valued one such as the label,
sends its rows to one or two tasks. The operators here cut the ordered rows
into slices, work inside each slice, and add the totals of the earlier slices,
which is a table of one row per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.ordering import hash_order
from adjudica.session import checkpointed

HASH_SLICE_DIGITS = 3  # 16^3 equal slices of the md5 range


def _earlier(columns: list[str]) -> "Window":
    return (
        Window.partitionBy(*columns)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def hash_ranked(df: DataFrame, key: str, group: str, seed: int = 42, out: str = "hash_rank") -> DataFrame:
    """Number the rows of each group in md5 order of the key, starting at 1.

    md5 is uniform, so its leading digits cut every group into even slices in
    the right order: a group holding most rows is spread over 4096 windows. The
    slice sizes are at most 4096 rows per group value; the groups are labels.
    """
    sliced = df.withColumn("_digest", hash_order(key, seed)).withColumn(
        "_slice", F.substring("_digest", 1, HASH_SLICE_DIGITS)
    )
    sizes = sliced.groupBy(F.col(group).alias("_group"), "_slice").agg(F.count("*").alias("_n"))
    offsets = sizes.select(
        "_group",
        F.col("_slice").alias("_offset_slice"),
        F.coalesce(F.sum("_n").over(_earlier(["_group"])), F.lit(0)).alias("_offset"),
    )
    local = F.row_number().over(Window.partitionBy(group, "_slice").orderBy("_digest", key))
    return (
        sliced.withColumn("_local", local)
        .join(
            offsets,
            F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_offset_slice")),
        )
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop("_digest", "_slice", "_group", "_offset_slice", "_offset", "_local")
    )


def running_totals(df: DataFrame, order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Running sum of each expression over the whole frame in the given order.

    ``order`` has to be a total order. Rows are range-partitioned on it, so
    equal leading values split across tasks by the later keys; the checkpoint
    pins which slice each row fell into before the slices are totalled.
    """
    measured = df.select("*", *[expr.alias(f"_in_{name}") for name, expr in totals.items()])
    sliced = checkpointed(
        measured.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    )
    per_slice = sliced.groupBy("_slice").agg(
        *[F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in totals]
    )
    # One row per task of the previous stage: this window is small by construction.
    offsets = per_slice.select(
        "_slice",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(_earlier([])), F.lit(0)).alias(f"_off_{name}")
            for name in totals
        ],
    )
    inside = (
        Window.partitionBy("_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.select(
            "*", *[F.sum(f"_in_{name}").over(inside).alias(f"_run_{name}") for name in totals]
        )
        .join(F.broadcast(offsets), "_slice")
        .select(
            *df.columns,
            *[(F.col(f"_run_{name}") + F.col(f"_off_{name}")).alias(name) for name in totals],
        )
    )


def global_row_number(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    return running_totals(df, order, {out: F.lit(1).cast("bigint")})


def ntile_bucket(row_number: Column, total: Column, buckets: int) -> Column:
    """NTILE in closed form: the first ``total % buckets`` buckets get one extra row."""
    size = F.call_function("div", total, F.lit(buckets))
    extra = total % buckets
    in_long = extra * (size + 1)
    long_bucket = F.call_function("div", row_number - 1, size + 1) + 1
    short_bucket = F.call_function(
        "div", row_number - in_long - 1, F.greatest(size, F.lit(1))
    ) + extra + 1
    return F.when(row_number <= in_long, long_bucket).otherwise(short_bucket)


def first_per_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """First row of each key in a total order.

    The ``== 1`` filter lets Spark keep one row per key and task before the
    shuffle, so a key repeated a billion times still sends one row per task.
    """
    keys = [key] if isinstance(key, str) else key
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where("_rn = 1").drop("_rn")
