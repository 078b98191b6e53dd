"""Line items to the dense weekly product-store panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.functions.columns import money_mean, money_sum, week_start
from tillwise.operators.ranks import grouped_median
from tillwise.staging import stage

SERIES = ("product_id", "store_id")


def top_n(df: DataFrame, key: str, amount: Column, n: int, into: str = "revenue") -> tuple[DataFrame, DataFrame]:
    """The ``n`` keys of highest total, ties by key, and the share of the total they cover.

    The totals are staged: the scan behind them runs once for both results.
    """
    totals = stage(
        df.where(F.col(key).isNotNull()).groupBy(key).agg(money_sum(amount).alias(into)), "totals"
    )
    top = totals.orderBy(F.desc(into), F.col(key).asc()).limit(n)
    marked = totals.join(F.broadcast(top.select(key, F.lit(True).alias("_top"))), key, "left")
    coverage = marked.agg(
        F.try_divide(
            money_sum(F.when(F.col("_top"), F.col(into))), money_sum(F.col(into))
        ).alias("coverage")
    )
    return top, coverage


def order_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Attach each order's day and store; lines without an order have no week and go."""
    return lines.join(orders.select("order_id", "order_date", "store_id"), "order_id", "left").where(
        F.col("order_date").isNotNull()
    )


def weekly_agg(lines: DataFrame) -> DataFrame:
    """Units, revenue and mean line price per product, store and week."""
    week = week_start(F.col("order_date"))
    return (
        lines.where("quantity IS NOT NULL AND unit_price IS NOT NULL AND order_date IS NOT NULL")
        .groupBy(*SERIES, week.alias("week"))
        .agg(
            F.sum("quantity").cast("long").alias("quantity"),
            money_sum(F.col("quantity") * F.col("unit_price")).alias("revenue"),
            money_mean(F.col("unit_price")).alias("unit_price"),
        )
    )


def densify(weekly: DataFrame, products: DataFrame, stores: Sequence[str], first, last) -> DataFrame:
    """A row for every product, store and week from ``first`` to ``last``; gaps are zero.

    The empty grid is generated from the product rows and appended to the data, and one
    exchange by (product, store) serves this aggregation and every window that follows.
    """
    weeks = f"explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 7 DAYS))"
    grid = (
        products.select("product_id")
        .withColumn("store_id", F.explode(F.array(*[F.lit(s) for s in stores])))
        .select(
            *SERIES, F.expr(weeks).alias("week"),
            F.lit(0).cast("long").alias("quantity"), F.lit(0.0).alias("revenue"),
            F.lit(0.0).alias("unit_price"),
        )
    )
    return (
        weekly.select(*grid.columns).unionByName(grid)
        .repartition(*SERIES)
        .groupBy(*SERIES, "week")
        .agg(
            F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"),
            F.max("unit_price").alias("unit_price"),
        )
    )


def fill_forward_back(df: DataFrame, column: str, keys: Sequence[str], order: str) -> DataFrame:
    """Zero means missing: take the last value before, else the first one after."""
    spec = W.partitionBy(*keys).orderBy(order)
    known = F.nullif(F.col(column), F.lit(0.0))
    earlier = F.last(known, ignorenulls=True).over(spec.rowsBetween(W.unboundedPreceding, 0))
    later = F.first(known, ignorenulls=True).over(spec.rowsBetween(0, W.unboundedFollowing))
    return df.withColumn(column, F.coalesce(earlier, later))


def weekly_panel(lines: DataFrame, top: DataFrame, stores: Sequence[str]) -> DataFrame:
    """The dense panel of the top products over all stores and weeks, prices filled.

    ``top`` is bounded by its N and steers the second scan as a broadcast semi join. The
    weekly table is staged, since its range of weeks must be known before the grid.
    """
    kept = lines.where(F.col("store_id").isin(list(stores))).join(
        F.broadcast(top.select("product_id")), "product_id", "left_semi"
    )
    weekly = stage(weekly_agg(kept), "weekly")
    first, last, priceless = weekly.groupBy(*SERIES).agg(
        F.min("week").alias("a"), F.max("week").alias("b"), F.max("unit_price").alias("p")
    ).agg(F.min("a"), F.max("b"), F.count_if(F.coalesce("p", F.lit(0.0)) > 0)).first()
    if first is None:
        return weekly
    dense = densify(weekly, top, stores, first, last)
    filled = fill_forward_back(dense, "unit_price", SERIES, "week")
    if priceless == top.count() * len(set(stores)):
        return filled  # every series has a price of its own
    medians = grouped_median(filled, ["product_id"], "unit_price", into="_median")
    return (
        filled.join(F.broadcast(medians), "product_id", "left")  # one row per top product
        .withColumn("unit_price", F.coalesce("unit_price", "_median"))
        .drop("_median")
    )
