"""The star-schema test tables read as retail concepts.

Items are parts, stores are the supplier's region at panel level, invoices are orders.
A brand number stands for the product of the weekly panel, its remainders for the
category and the department.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.config import STATES
from tillwise.functions.columns import order_key, week_start
from tillwise.operators.customers import line_totals
from tillwise.operators.joins import dim_join
from tillwise.sources.tables import read_table

# Days the calendar goes on after the last sale.
CALENDAR_AHEAD = 42
# Open lines shipped in so many last days count as stock.
STOCK_DAYS = 42


# Declared, so that opening a table needs no job to read file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def _unit_price() -> Column:
    """Price per unit in whole cents."""
    cents = "cast(rint(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)"
    return F.expr(cents) / 100.0


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with an integer quantity and a unit price in whole cents."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").cast("long").alias("quantity"),
        _unit_price().alias("unit_price"),
    )


def supplier_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier_id -> store_id such as ``CA_0``, with the state it lies in."""
    state = F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col("n_regionkey") % 3 + 1)
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return dim_join(supplier, nation, "s_nationkey", "inner").select(
        F.col("s_suppkey").alias("supplier_id"),
        F.concat_ws("_", state, F.col("n_regionkey")).alias("store_id"),
        state.alias("state"),
    )


def _brand() -> Column:
    return F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")


def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id -> product, department and category of the weekly panel."""
    brand = F.col("b")
    cat = F.element_at(F.array(F.lit("FOODS"), F.lit("HOBBIES"), F.lit("HOUSEHOLD")), brand % 3 + 1)
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("item_id"), _brand().alias("b"))
        .select("item_id", "b", cat.alias("cat_id"))
        .withColumn("dept_id", F.concat_ws("_", "cat_id", brand % 7))
        .withColumn("product_id", F.concat_ws("_", "dept_id", "b"))
        .select("item_id", "product_id", "dept_id", "cat_id")
    )


def panel_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per panel product."""
    return part_products(spark, sf_dir).select("product_id", "dept_id", "cat_id").distinct()


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale lines with their store."""
    return dim_join(
        sale_lines(spark, sf_dir), supplier_stores(spark, sf_dir), "supplier_id", "inner"
    ).drop("supplier_id")


def panel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of the weekly panel: product, store, day, quantity, unit price."""
    products = part_products(spark, sf_dir).select("item_id", "product_id")
    return dim_join(store_sales(spark, sf_dir), products, "item_id", "inner").select(
        order_key(F.col("store_id"), F.col("date")).alias("order_id"),
        "product_id", "store_id", F.col("date").alias("order_date"), "quantity", "unit_price",
    )


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units sold per item, store and day, the long form of the wide sales table."""
    return (
        store_sales(spark, sf_dir).groupBy("item_id", "store_id", "date")
        .agg(F.sum("quantity").alias("quantity"))
    )


def weekly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price per store, item and week."""
    week = week_start(F.col("date"))
    return (
        store_sales(spark, sf_dir).groupBy("store_id", "item_id", week.alias("week"))
        .agg(F.max("unit_price").alias("sell_price"))
    )


def prices_with_gaps(prices: DataFrame) -> DataFrame:
    """Work for the imputation: every seventh item has no price at all, and others miss
    every fifth week."""
    number = F.expr("date_diff(week, DATE'1994-01-03') div 7")
    return prices.where((F.col("item_id") % 7 != 0) & ((F.col("item_id") + number) % 5 != 0))


def open_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per panel product and store: units on the open lines of the last weeks."""
    day = F.col("l_shipdate").cast("date")
    lines = table(spark, sf_dir, "lineitem")
    since = lines.agg(F.max(day)).first()[0] - timedelta(days=STOCK_DAYS)
    still_open = lines.where((F.col("l_linestatus") == "O") & (F.col("l_shipdate") >= F.lit(since + timedelta(days=1)))).select(
        F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
    )
    stores = supplier_stores(spark, sf_dir).select("supplier_id", "store_id")
    products = part_products(spark, sf_dir).select("item_id", "product_id")
    placed = dim_join(dim_join(still_open, stores, "supplier_id", "inner"), products, "item_id", "inner")
    return placed.groupBy("product_id", "store_id").agg(F.sum("quantity").cast("double").alias("current_stock"))


def calendar_days(first: date, last: date, spark: SparkSession) -> DataFrame:
    """Every day from ``first`` to ``last`` with its events and benefit-payment flags."""
    month, day, weekday = F.month("date"), F.dayofmonth("date"), F.weekday("date")
    fixed = lambda m, d: (month == m) & (day == d)
    nth = lambda m, wd, n: (month == m) & (weekday == wd) & (F.ceil(day / 7) == n)
    events = [
        (fixed(1, 1), "NewYear", "National"),
        (fixed(1, 7), "OrthodoxChristmas", "Religious"),
        (nth(2, 6, 1), "SuperBowl", "Sporting"),
        (nth(4, 6, 2), "Easter", "Religious"),
        (nth(5, 6, 2), "Mother's day", "Cultural"),
        (nth(6, 6, 3), "NBAFinalsEnd", "Sporting"),
        (fixed(7, 4), "IndependenceDay", "National"),
        (nth(9, 0, 1), "LaborDay", "National"),
        (fixed(10, 31), "Halloween", "Cultural"),
        (nth(11, 3, 4), "Thanksgiving", "National"),
        (fixed(12, 25), "Christmas", "National"),
    ]
    second = [
        (nth(4, 6, 2) & (day % 2 == 0), "OrthodoxEaster", "Religious"),
        (nth(6, 6, 3), "Father's day", "Cultural"),
    ]

    def pick(rules: list, at: int) -> Column:
        return F.coalesce(*[F.when(rule[0], rule[at]) for rule in rules])

    snap = {f"snap_{s}": day.between(1 + 2 * i, 10 + 2 * i).cast("int") for i, s in enumerate(STATES)}
    return (
        spark.sql(
            f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 1 DAY)) AS date"
        )
        .withColumns({
            "event_name_1": pick(events, 1), "event_type_1": pick(events, 2),
            "event_name_2": pick(second, 1), "event_type_2": pick(second, 2),
            **snap,
        })
    )


def sales_calendar(spark: SparkSession, sf_dir: str, ahead: int = CALENDAR_AHEAD) -> DataFrame:
    """The calendar over the days of the line items and some days beyond."""
    day = F.col("l_shipdate").cast("date")
    first, last = table(spark, sf_dir, "lineitem").agg(F.min(day), F.max(day)).first()
    return calendar_days(first, last + timedelta(days=ahead), spark)


def transactions(spark: SparkSession, sf_dir: str, returns: bool = False) -> DataFrame:
    """Invoice lines: invoice, customer, date, quantity, price, country.

    With ``returns``, returned lines have a negative quantity and open orders count as
    cancelled (invoice number starting with C), which gives the cleaning rules work.
    """
    units = F.col("l_quantity").cast("long")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        (F.when(F.col("l_returnflag") == "R", -units).otherwise(units) if returns else units).alias("quantity"),
        _unit_price().alias("price"),
    )
    invoice = F.col("o_orderkey").cast("string")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        (F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C"), invoice)).otherwise(invoice)
         if returns else invoice).alias("invoice"),
        F.col("o_orderdate").alias("invoice_date"),
    )
    return dim_join(lines, orders, "o_orderkey", "inner").select(
        "invoice", "customer_id", "invoice_date", "quantity", "price"
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice totals, aggregated below the join: an order with very many lines reaches
    the shuffle as one partial row per task, and the join is one row to one row."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_quantity").cast("long").alias("quantity"),
        _unit_price().alias("price"),
    )
    totals = lines.where("quantity > 0 AND price > 0").groupBy("o_orderkey").agg(*line_totals())
    orders = table(spark, sf_dir, "orders").where("o_custkey IS NOT NULL").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("invoice_date"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("country")
    )
    joined = orders.join(totals, "o_orderkey").withColumnRenamed("o_orderkey", "invoice")
    return dim_join(joined, customers, "customer_id", "left")
