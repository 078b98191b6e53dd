"""Joins of a large fact table to a dimension, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``; an upper bound for filtered file scans."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dim_join(
    fact: DataFrame, dim: DataFrame, key: str, how: str = "left", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join ``fact`` to ``dim``, which has one row per ``key``.

    A dimension of checked small size is broadcast. A larger one is joined by one shuffle of
    one read of the fact; adaptive execution splits the fact's side of a hot key, as the other
    side has a single row for it.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    if plan_bytes(dim) <= broadcast_bytes:
        return fact.join(F.broadcast(dim), key, how)
    return fact.join(dim, key, how)
