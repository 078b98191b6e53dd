"""Global order statistics without a one-task sort.

Spark evaluates a window without ``PARTITION BY`` in a single task. Here the rows are
range-partitioned by the full sort key, written once, and each range is ranked on its own
from the number of rows in the ranges before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.staging import stage


def running_total(
    df: DataFrame,
    order: Sequence[str],
    weight: Column | None = None,
    into: str = "running",
) -> DataFrame:
    """Add the running sum of ``weight`` (default: a row number from 1) in ``order``.

    ``order`` must be unique per row, ascending, nulls last; a unique order also splits
    any run of equal leading values over several ranges.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    weighted = df.withColumn("_w", F.lit(1).cast("long") if weight is None else weight)
    upto = (W.unboundedPreceding, W.currentRow)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(
        weighted.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    # One row per range, so this window is bounded by the number of partitions.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.sum("_w").alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")
    )
    spec = W.partitionBy("_part").orderBy(*keys).rowsBetween(*upto)
    return (
        ranged.join(F.broadcast(starts), "_part")
        .withColumn(into, F.sum("_w").over(spec) + F.col("_start"))
        .drop("_w", "_part", "_start")
    )


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float | None]:
    """Exact linearly interpolated quantiles of one column, nulls skipped.

    Equal values collapse into counts before anything is sorted; the driver receives two
    numbers per probability.
    """
    counts = stage(
        df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n")),
        "histogram",
    )
    total = counts.agg(F.sum("_n")).first()[0]
    if not total:
        return [None for _ in probabilities]
    ranked = running_total(counts, [value], F.col("_n"), "_upto")
    places = [(total - 1) * p for p in probabilities]
    picks = [
        F.min(F.when(F.col("_upto") > side(place), F.col(value)))
        for place in places
        for side in (math.floor, math.ceil)
    ]
    found = ranked.agg(*[c.alias(f"q{i}") for i, c in enumerate(picks)]).first()
    return [
        float(found[2 * i] + (found[2 * i + 1] - found[2 * i]) * (place - math.floor(place)))
        for i, place in enumerate(places)
    ]


def grouped_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: Column | None = None,
    into: str = "median",
    extremes: Sequence[str] = (),
) -> DataFrame:
    """Exact median of ``value`` per group, one row per group with a non-null value.

    Rows first collapse to (group, value, count). The medians come from one running total
    over all groups, so a group with very many distinct values is spread over several tasks. ``extremes`` names columns for
    the minimum and the maximum, taken from the same counts.
    """
    keys = list(keys)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.sum(F.lit(1) if weight is None else weight).cast("long").alias("_n"))
        .where("_n > 0")
    )
    edges = [f(value).alias(name) for f, name in zip((F.min, F.max), extremes)]
    ranked = stage(running_total(counts, [*keys, value], F.col("_n"), "_upto"), "ranked-histogram")
    spans = ranked.groupBy(*keys).agg(
        F.min(F.col("_upto") - F.col("_n")).alias("_start"), F.sum("_n").alias("_rows")
    ).select(
        *(F.col(k).alias(f"_of_{k}") for k in keys),  # a null group joins as well
        (F.col("_start") + F.floor((F.col("_rows") - 1) / 2)).alias("_low"),
        (F.col("_start") + F.ceil((F.col("_rows") - 1) / 2)).alias("_high"),
    )

    def at(place: str) -> Column:
        return F.min(F.when(F.col("_upto") > F.col(place), F.col(value)))

    return (
        ranked.join(spans, reduce(lambda a, k: a & F.col(k).eqNullSafe(F.col(f"_of_{k}")), keys, F.lit(True)))
        .groupBy(*keys)
        .agg(((at("_low") + at("_high")) / 2).alias(into), *edges)
    )


def quintile_by_edges(
    df: DataFrame, value: str, into: str, reverse: bool = False, duplicates: str = "raise"
) -> DataFrame:
    """Scores 1..5 from right-closed quantile edges of the values themselves.

    Equal edges raise, as binning by quantiles cannot name five bins then; with
    ``duplicates="drop"`` the remaining bins keep consecutive scores.
    """
    edges = exact_quantiles(df, value, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])
    if edges[0] is None:
        return df.withColumn(into, F.lit(None).cast("int"))
    if len(set(edges)) < len(edges):
        if duplicates != "drop":
            raise ValueError(f"bin edges of {value} are not unique: {edges}")
        edges = sorted(set(edges))
    bins = max(len(edges) - 1, 1)
    score = F.lit(1)
    for edge in edges[1:-1]:
        score = score + (F.col(value) > edge).cast("int")
    score = F.lit(bins + 1) - score if reverse else score
    return df.withColumn(into, F.when(F.col(value).isNotNull(), score).cast("int"))


def quintile_by_rank(
    df: DataFrame, value: str, tie: str, into: str, rows: int | None = None
) -> DataFrame:
    """Scores 1..5 from the unique rank of ``value``, ties in order of ``tie``."""
    n = df.count() if rows is None else rows
    ranked = running_total(df, [value, tie], None, "_rank")
    # Integer form of ceil(5 * (rank - 1) / (n - 1)).
    place = F.expr(f"(5 * (_rank - 1) + {max(n - 2, 0)}) div {max(n - 1, 1)}")
    return ranked.withColumn(into, F.least(F.greatest(place, F.lit(1)), F.lit(5)).cast("int")).drop("_rank")
