"""Embedding rows as packed bytes, and classes of equal vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, str]:
    """(vec_id, dim, vec, digest) of the rows with a usable vector, and the number
    format of ``vec``: as stored, single or double. Left out are null ids and
    vectors that are null, empty, zero, or hold null or non-finite components."""
    kind = "<f4" if "array<float>" in dict(df.dtypes)[vec_col] else "<f8"
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    usable = (
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.exists("vec", lambda x: x != 0)
        & F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(v, kind) + np.array(0, kind) for v in batch["vec"].to_pylist()]  # -0.0 becomes 0.0
            data = [v.tobytes() for v in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"], pa.array([len(v) for v in found], pa.int32()), pa.array(data, pa.binary()),
                    pa.array([hashlib.blake2b(d, digest_size=16).digest() for d in data], pa.binary()),
                ],
                names=["vec_id", "dim", "vec", "digest"],
            )

    return rows.where(F.coalesce(usable, F.lit(False))).mapInArrow(run, "vec_id long, dim int, vec binary, digest binary"), kind


def classes(rows: DataFrame) -> DataFrame:
    """(k, dim, vec, size) of the distinct vectors; k is the smallest id that has it."""
    return rows.groupBy("digest").agg(
        F.min("vec_id").alias("k"), F.first("dim").alias("dim"), F.first("vec").alias("vec"), F.count("*").alias("size")
    )


def matrix(vectors: list[bytes], kind: str, as_type: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(as_type)
