"""Seeded order keys.

A row's random position is the md5 of "<seed>:<key1>:<key2>..." (lowercase
hex). It depends only on the seed and the row's key, never on partitioning,
and any SQL engine with md5 computes the same string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed, *cols) -> Column:
    parts = [F.lit(str(seed))] + [
        (F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))
