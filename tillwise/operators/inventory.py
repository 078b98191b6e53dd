"""Stock cover per product and store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.functions.columns import product_label, stock_status, tier
from tillwise.operators.panel import SERIES


def inventory_coverage(base: DataFrame, stock: DataFrame, min_weekly: float = 1.0) -> DataFrame:
    """Weeks to stockout and status; slow movers below ``min_weekly`` units are left out.

    The status looks at the weeks after rounding half-even to one decimal, so 2.05 weeks
    are still Critical.
    """
    weeks = F.bround(F.try_divide("current_stock", "avg_weekly_qty"), 1)
    return (
        base.where(F.col("avg_weekly_qty") >= min_weekly)
        .join(stock.select(*SERIES, "current_stock"), list(SERIES), "left")
        .withColumn("weeks_to_stockout", weeks)
        .withColumn("status", stock_status(F.col("weeks_to_stockout")))
    )


def status_counts(coverage: DataFrame) -> DataFrame:
    """Items per status, and the share of safe ones in percent; one row."""
    count = lambda label: F.count_if(F.col("status") == label)
    return coverage.agg(
        count("Critical").alias("critical"), count("Warning").alias("warning"),
        count("Safe").alias("safe"), F.count("*").alias("total"),
        F.bround(F.try_divide(count("Safe"), F.count("*")) * 100, 1).alias("safe_pct"),
    )


def category_cover(coverage: DataFrame) -> DataFrame:
    """Mean weeks of cover per category."""
    return coverage.groupBy("cat_id").agg(F.avg("weeks_to_stockout").alias("mean_weeks"))


def critical_by_store(coverage: DataFrame, stores: Sequence[str]) -> DataFrame:
    """Critical items of every store, 0 for those without any."""
    spark = coverage.sparkSession
    every = spark.createDataFrame([(s,) for s in sorted(set(stores))], "store_id string")
    counts = coverage.where("status = 'Critical'").groupBy("store_id").agg(F.count("*").alias("n"))
    return every.join(counts, "store_id", "left").select(
        "store_id", F.coalesce("n", F.lit(0)).alias("critical")
    )


def critical_items(coverage: DataFrame, prices: DataFrame, n: int = 20, weeks: int = 12) -> DataFrame:
    """The ``n`` critical items nearest to stockout, ties by product and store."""
    order = [F.col("weeks_to_stockout").asc_nulls_last(), *[F.col(c).asc() for c in SERIES]]
    first = coverage.where("status = 'Critical'").orderBy(*order).limit(n)
    demand = F.bround("avg_weekly_qty", 1)
    return (
        first.withColumn("rank", F.row_number().over(W.orderBy(*order)))  # n rows
        .join(prices.select("product_id", "median_price"), "product_id", "left")
        .select(
            "rank", "product_id", product_label(F.col("product_id"), F.col("cat_id")).alias("product"),
            "cat_id", "store_id", "weeks_to_stockout", demand.alias("demand"),
            F.bround(demand * weeks, 0).alias("demand_ahead"),
            F.coalesce("median_price", F.lit(0.0)).alias("price"),
            tier(F.col("weeks_to_stockout"), (1.0,), ("CRITICAL", "WARNING"), right=True).alias("priority"),
        )
    )
