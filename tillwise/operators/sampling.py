"""Samples of bounded size that do not depend on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows: those of smallest key hash. ``keys`` are unique together."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)
