"""Repeatable pseudo-random draws from a row's id, independent of order and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10_000


def hash_draw(seed: str | Column, id_col: str, offset: int = 1) -> Column:
    """Eight hex digits of ``md5(seed || id)`` as a BIGINT in [0, 2^32)."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    digest = F.md5(F.concat(seed, F.col(id_col).cast("string")))
    return F.conv(F.substring(digest, offset, 8), 16, 10).cast("bigint")


def hash_bucket(seed: str | Column, id_col: str, offset: int = 1) -> Column:
    """The draw folded to 0..9999."""
    return hash_draw(seed, id_col, offset) % F.lit(BUCKETS)
