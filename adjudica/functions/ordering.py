"""Repeatable pseudo-random order: the md5 digest of seed and key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(key: Column | str, seed: int = 42) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), key))
