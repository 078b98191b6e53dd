"""Wide daily sales to products, stores, orders and line items."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.functions.columns import constant_map, money_sum, order_key
from tillwise.operators.ranks import grouped_median
from tillwise.staging import stage

#: Sales that a task turns into the wide form; each may become a wide row of its own, of some 400 bytes.
PIVOT_ROWS = 200_000


def day_columns(wide: DataFrame, prefix: str = "d_") -> list[str]:
    """The day columns, found from the schema alone."""
    return [c for c in wide.columns if c.startswith(prefix)]


def pivot_sales(
    sales: DataFrame, ids: Sequence[str], day: str, quantity: str, days: Sequence[str], rows: int
) -> DataFrame:
    """One row per id with the units of each of ``days`` as a column, null without sales.

    A wide row is far larger than a sale, so the sales are dealt by their ids into tasks of some
    ``PIVOT_ROWS`` of the about ``rows`` sales: a task holds no more wide rows than that, whatever the size of
    the table, and both sums of the pivot go by that one shuffle.
    """
    dealt = sales.select(*ids, day, quantity).repartition(max(1, math.ceil(rows / PIVOT_ROWS)), *ids)
    return dealt.groupBy(*ids).pivot(day, list(days)).agg(F.sum(quantity))


def unpivot_sales(wide: DataFrame, ids: Sequence[str], prefix: str = "d_") -> DataFrame:
    """One row per id and day with units sold; days without sales are dropped.

    One scan, no shuffle: every input row expands in place.
    """
    return (
        wide.unpivot(list(ids), day_columns(wide, prefix), "d", "quantity")
        .where(F.col("quantity") > 0)
    )


def price_stats(prices: DataFrame, key: str, price: str) -> DataFrame:
    """Exact median, minimum and maximum price per key."""
    return grouped_median(prices, [key], price, into="median_price", extremes=("price_min", "price_max"))


def products_table(items: DataFrame, prices: DataFrame, key: str, price: str) -> DataFrame:
    """Distinct products with their price statistics, if they have a price."""
    return items.distinct().join(price_stats(prices, key, price), key, "left")


def stores_table(stores: DataFrame, regions: Mapping[str, str]) -> DataFrame:
    """Distinct stores with their state's region."""
    return stores.select("store_id", "state").distinct().withColumn(
        "region", constant_map(F.col("state"), regions)
    )


def attach_prices(sales: DataFrame, prices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on (store, item, week): both sides have one row per key, so no key is hot."""
    return sales.join(prices, list(keys), "left")


def impute_price(
    sales: DataFrame, chunk: str, item: str, store: str, price: str
) -> DataFrame:
    """Fill missing prices by the item's median in its (store, chunk), then by the median
    of that whole (store, chunk) after the first fill.

    Sales have one row per item, store and day, so the first window holds at most one
    chunk of days. The second group is large: it is medianed over counts per price.
    """
    scope = [store, chunk]
    own = F.percentile(price, 0.5).over(W.partitionBy(*scope, item))
    filled = stage(sales.withColumn(price, F.coalesce(F.col(price), own)), "priced")
    by_scope = grouped_median(filled, scope, price, None, "_scope")
    by_scope = by_scope.select(F.col(store).alias("_store"), F.col(chunk).alias("_chunk"), "_scope")
    same = F.col(store).eqNullSafe(F.col("_store")) & F.col(chunk).eqNullSafe(F.col("_chunk"))
    return (
        filled.join(by_scope, same, "left")  # one row per scope; the sales of a large one are split
        .withColumn(price, F.coalesce(price, "_scope"))
        .drop("_store", "_chunk", "_scope")
    )


def line_items_table(sales: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Priced sales as line items with their store-day order key and line total."""
    return sales.select(
        order_key(F.col("store_id"), F.col("date")).alias("order_id"),
        F.col("store_id"), F.col("date").alias("order_date"),
        F.col("item_id").alias("product_id"), "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("total_line"),
        *keep,
    )


def orders_table(lines: DataFrame) -> DataFrame:
    """Amount, units and distinct products per store-day.

    Lines first collapse to one row per (order, product), so a huge order is spread over
    its products and the distinct count needs no second copy of the rows.
    """
    per_product = lines.groupBy("order_id", "store_id", "order_date", "product_id").agg(
        money_sum(F.col("quantity") * F.col("unit_price")).alias("_amount"),
        F.sum("quantity").alias("_units"),
    )
    return per_product.groupBy("order_id", "store_id", "order_date").agg(
        money_sum(F.col("_amount")).alias("total_amount"),
        F.sum("_units").alias("total_units"),
        F.count("product_id").alias("n_items"),
    )


def build_sales_tables(
    wide: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    chunk_days: int,
    regions: Mapping[str, str],
    keep: Sequence[str] = ("event_name_1", "event_type_1", "snap_CA", "snap_TX", "snap_WI"),
) -> dict[str, DataFrame]:
    """Wide sales, calendar and prices to the four normalised tables.

    ``wide`` has id, item_id, dept_id, cat_id, store_id, state_id and one column per day;
    ``calendar`` maps the day columns to dates and price weeks, one row per day.
    """
    ids = ["item_id", "store_id"]
    days = F.broadcast(calendar.select("d", "date", "wm_yr_wk", *keep))  # one row per day
    number = F.regexp_extract("d", r"(\d+)$", 1).cast("int")
    sales = (
        unpivot_sales(wide.select(*ids, *day_columns(wide)), ids)
        .withColumn("chunk", F.floor((number - 1) / chunk_days))
        .join(days, "d", "left")
    )
    priced = attach_prices(
        sales, prices.withColumnRenamed("sell_price", "unit_price"), ["store_id", "item_id", "wm_yr_wk"]
    )
    lines = line_items_table(impute_price(priced, "chunk", "item_id", "store_id", "unit_price"), keep)
    items = wide.select("item_id", "dept_id", "cat_id")
    return {
        "products": products_table(items, prices, "item_id", "sell_price")
        .withColumnRenamed("item_id", "product_id"),
        "stores": stores_table(wide.select("store_id", F.col("state_id").alias("state")), regions),
        "orders": orders_table(lines),
        "line_items": lines.select("order_id", "product_id", "quantity", "unit_price", *keep),
    }


def run_summary(lines: DataFrame, day: str, order: str, product: str, store: str, amount: str) -> DataFrame:
    """Date range, row and distinct counts, and revenue in one row.

    Each task first drops its repeated values, so the shuffle carries distinct keys only.
    """
    return lines.agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.count("*").alias("line_items"),
        F.count_distinct(order).alias("orders"),
        F.count_distinct(product).alias("products"),
        F.count_distinct(store).alias("stores"),
        money_sum(F.col(amount)).alias("revenue"),
    )
