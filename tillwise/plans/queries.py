"""The registered queries: each operator family run over the star-schema tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.config import STATE_REGION, CustomerConfig, SplitConfig
from tillwise.functions.columns import (
    churn_tier, money_sum, product_label, round_doubles, store_name, week_start,
)
from tillwise.operators import calendar as cal
from tillwise.operators import customers as cust
from tillwise.operators import features as feat
from tillwise.operators import forecast as fc
from tillwise.operators import inventory as stock
from tillwise.operators import panel as pan
from tillwise.operators import sales
from tillwise.operators.joins import dim_join
from tillwise.operators.metrics import regression_metrics, temporal_split
from tillwise.operators.sampling import bounded_sample
from tillwise.plans import reports as rep
from tillwise.sources import star
from tillwise.sources.tables import coerce, conform, drop_repeated_headers, rejected_rows, stack_vintages
from tillwise.staging import scratch_dir, stage
from tillwise.streaming.weekly import resume_weekly_totals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOP_N = 20
SPLIT = SplitConfig(train_end=date(1999, 12, 31), val_end=date(2000, 12, 31))

# Fixed weights of the scorer that stands in for a model where SQL must repeat the result.
WEIGHTS = {
    "lag_1": 0.473127, "lag_4": 0.211353, "lag_52": 0.151719, "rolling_mean_8": 0.101357,
    "rolling_std_4": 0.053171, "has_event": 1.250731, "snap_days": 0.313717,
    "price_vs_median_ratio": 0.701113,
}
LOW = {"pred": 0.810317, "rolling_std_8": -0.251371}
HIGH = {"pred": 1.170719, "rolling_std_12": 0.413131}


def query(run: Query) -> Query:
    """Register under the function's name, doubles rounded to six digits."""

    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(run(spark, sf_dir))

    QUERIES[run.__name__] = rounded
    return run


class Panel:
    """The weekly panel and its inputs for one data folder, each built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def lines(self) -> DataFrame:
        return star.panel_lines(self.spark, self.sf_dir)

    @cached_property
    def stores(self) -> list[str]:
        """The store ids, a handful."""
        rows = star.supplier_stores(self.spark, self.sf_dir).select("store_id").distinct().collect()
        return sorted(r[0] for r in rows)

    @cached_property
    def ranking(self) -> tuple[DataFrame, DataFrame]:
        return pan.top_n(self.lines, "product_id", F.col("quantity") * F.col("unit_price"), TOP_N)

    @cached_property
    def top(self) -> DataFrame:
        return self.ranking[0]

    @cached_property
    def products(self) -> DataFrame:
        """Attributes of the top products, read from the part table once."""
        top = F.broadcast(self.top.select("product_id"))  # TOP_N rows
        every = star.panel_products(self.spark, self.sf_dir)
        return stage(every.join(top, "product_id", "left_semi"), "products")

    @cached_property
    def panel(self) -> DataFrame:
        return pan.weekly_panel(self.lines, self.top, self.stores)

    @cached_property
    def days(self) -> DataFrame:
        return star.sales_calendar(self.spark, self.sf_dir)

    @cached_property
    def calendar(self) -> DataFrame:
        return cal.weekly_calendar(self.days)

    @cached_property
    def features(self) -> DataFrame:
        return feat.demand_features(self.panel, self.calendar, self.products, self.stores)

    @cached_property
    def prices(self) -> DataFrame:
        """Median price per top product over its store-week prices."""
        sold = self.panel.where("quantity > 0")
        stats = sales.price_stats(sold, "product_id", "unit_price")
        return self.products.join(F.broadcast(stats), "product_id", "left")

    @cached_property
    def scorer(self) -> fc.LinearScorer:
        return fc.LinearScorer(WEIGHTS, LOW, HIGH)

    def forecast(self, rolling: str = "seed_deque") -> DataFrame:
        return fc.forecast(self.features, self.days, self.calendar, self.scorer, rolling=rolling)

    @cached_property
    def valued_forecast(self) -> DataFrame:
        return stage(fc.forecast_revenue(self.forecast(), self.prices), "forecast")

    @cached_property
    def inventory(self) -> DataFrame:
        base = stage(feat.inventory_base(self.features, self.products), "velocity")  # a row per series
        return stock.inventory_coverage(base, stock_on_hand(base, star.open_stock(self.spark, self.sf_dir)))

    @cached_property
    def daily(self) -> DataFrame:
        """Revenue per store and day of all products, as wide as the report needs."""
        return stage(rep.daily_revenue(self.lines), "daily")


def stock_on_hand(base: DataFrame, units: DataFrame) -> DataFrame:
    """The stock of every series, 0 where no unit is left."""
    series = ["product_id", "store_id"]
    return base.select(*series).join(units, series, "left").na.fill(0.0, ["current_stock"])


# ---- sources and sales tables --------------------------------------------------------

@query
def scan_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star.table(spark, sf_dir, "orders").withColumn("priority", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)))
    shaped = conform(
        raw,
        {"order_id": "bigint", "customer_id": "bigint", "order_date": "date", "total_amount": "double",
         "priority": "int", "channel": "string"},
        aliases={"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderdate": "order_date",
                 "o_totalprice": "total_amount"},
        defaults={"channel": "store"},
    )
    return shaped.dropna(subset=["order_date"])


def _text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as damaged text: unparseable quantities, repeated header rows."""
    return star.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 6, "flag").otherwise(F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("amount"),
    )


@query
def coerce_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_headers(_text_lines(spark, sf_dir), "flag")
    clean = coerce(kept, numeric=["quantity", "amount"], required=["quantity", "amount"])
    return clean.groupBy("flag").agg(
        F.count("*").alias("n"), F.sum(F.col("quantity").cast("long")).alias("units"),
        money_sum(F.col("amount")).alias("amount"),
    )


@query
def coerce_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_rows(drop_repeated_headers(_text_lines(spark, sf_dir), "flag"), ["quantity", "amount"])


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.panel_lines(spark, sf_dir).withColumn("amount", F.col("quantity") * F.col("unit_price"))
    return sales.run_summary(lines, "order_date", "order_id", "product_id", "store_id", "amount")


@query
def unpivot_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = [f"d_{d}" for d in range(1, 32)]
    daily = star.store_sales(spark, sf_dir).withColumn("d", F.concat(F.lit("d_"), F.dayofmonth("date")))
    rows = star.table(spark, sf_dir, "lineitem").count()  # from the file footers
    wide = sales.pivot_sales(daily, ["item_id", "store_id"], "d", "quantity", days, rows).na.fill(0)
    return sales.unpivot_sales(wide, ["item_id", "store_id"])


@query
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = star.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("dept_id"), F.col("p_type").alias("cat_id")
    )
    out = sales.products_table(items, star.weekly_prices(spark, sf_dir), "item_id", "sell_price")
    return out.withColumnRenamed("item_id", "product_id")


@query
def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.stores_table(star.supplier_stores(spark, sf_dir), STATE_REGION)


@query
def store_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = star.supplier_stores(spark, sf_dir).select("store_id").distinct()
    return every.withColumn("name", store_name(F.col("store_id")))


def _priced_sales(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Daily sales with weekly prices attached and gaps filled, in chunks of 200 days."""
    day_number = F.datediff("date", F.lit(date(1995, 1, 2)))
    daily = star.daily_sales(spark, sf_dir).withColumns({
        "week": week_start(F.col("date")), "chunk": F.floor(day_number / 200).cast("int"),
    })
    prices = star.weekly_prices(spark, sf_dir)
    prices = (star.prices_with_gaps(prices) if gaps else prices).withColumnRenamed("sell_price", "unit_price")
    joined = sales.attach_prices(daily, prices, ["store_id", "item_id", "week"])
    return sales.impute_price(joined, "chunk", "item_id", "store_id", "unit_price")


@query
def price_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _priced_sales(spark, sf_dir, gaps=True).select("store_id", "item_id", "date", "chunk", "quantity", "unit_price")


@query
def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = star.sales_calendar(spark, sf_dir).select("date", "event_name_1", "event_type_1", "snap_CA", "snap_TX", "snap_WI")
    priced = _priced_sales(spark, sf_dir).join(F.broadcast(days), "date", "left")  # a row per day
    return sales.line_items_table(priced, ["event_name_1", "event_type_1", "snap_CA", "snap_TX", "snap_WI"])


@query
def store_day_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.orders_table(sales.line_items_table(_priced_sales(spark, sf_dir)))


# ---- weekly panel and features -------------------------------------------------------

@query
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.sale_lines(spark, sf_dir)
    top, _ = pan.top_n(lines, "item_id", F.col("quantity") * F.col("unit_price"), 200)
    return top


@query
def top_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.sale_lines(spark, sf_dir)
    _, coverage = pan.top_n(lines, "item_id", F.col("quantity") * F.col("unit_price"), 200)
    return coverage


@query
def weekly_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.weekly_calendar(star.sales_calendar(spark, sf_dir))


@query
def average_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.average_snap(star.sales_calendar(spark, sf_dir))


@query
def weekly_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines meet their orders by key first, as separate tables would."""
    lines = star.panel_lines(spark, sf_dir)
    orders = lines.select("order_id", "order_date", "store_id").distinct()
    bare = lines.select("order_id", "product_id", "quantity", "unit_price")
    return pan.weekly_agg(dim_join(bare, orders, "order_id", "left"))


@query
def weekly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Panel(spark, sf_dir).panel


def _panel_keys() -> list[str]:
    return ["product_id", "store_id", "week"]


@query
def feat_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feat.add_lags(Panel(spark, sf_dir).panel)
    return out.select(*_panel_keys(), *[c for c in out.columns if c.startswith("lag_")])


@query
def feat_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feat.add_rolling(Panel(spark, sf_dir).panel)
    return out.select(*_panel_keys(), *[c for c in out.columns if c.startswith("rolling_")])


@query
def feat_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.add_yoy(Panel(spark, sf_dir).panel).select(*_panel_keys(), "yoy_growth")


@query
def feat_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.add_price_features(Panel(spark, sf_dir).panel).select(
        *_panel_keys(), "unit_price", "price_lag_1", "price_change", "price_vs_median_ratio"
    )


@query
def feat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = feat.encoded_products(Panel(spark, sf_dir).products)
    return codes.withColumn("name", product_label(F.col("product_id"), F.col("cat_id")))


@query
def demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Panel(spark, sf_dir).features


@query
def temporal_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal_split(Panel(spark, sf_dir).features, config=SPLIT).groupBy("split").agg(
        F.min("week").alias("first_week"), F.max("week").alias("last_week"),
        F.count("*").alias("n"), F.sum("quantity").alias("units"),
    )


# ---- inventory -----------------------------------------------------------------------

@query
def inventory_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Panel(spark, sf_dir)
    return feat.inventory_base(p.features, p.products)


@query
def inventory_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Panel(spark, sf_dir).inventory


@query
def inventory_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock.status_counts(Panel(spark, sf_dir).inventory)


@query
def category_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock.category_cover(Panel(spark, sf_dir).inventory)


@query
def critical_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Panel(spark, sf_dir)
    return stock.critical_by_store(p.inventory, p.stores)


@query
def inventory_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Panel(spark, sf_dir)
    return stock.critical_items(p.inventory, p.prices)


# ---- customers -----------------------------------------------------------------------

@query
def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cust.clean_transactions(star.transactions(spark, sf_dir, returns=True))


@query
def union_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = star.transactions(spark, sf_dir)
    newer = F.col("invoice_date") >= F.lit(date(1998, 7, 1))
    second = every.where(newer).withColumnsRenamed({"invoice": "InvoiceNo", "price": "UnitPrice", "customer_id": "CustomerID"})
    both = stack_vintages(
        [every.where(~newer), second],
        [{}, {"InvoiceNo": "invoice", "UnitPrice": "price", "CustomerID": "customer_id"}],
    )
    return both.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("items"),
        money_sum(F.col("quantity") * F.col("price")).alias("revenue"),
        F.min("invoice_date").cast("date").alias("first_day"), F.max("invoice_date").cast("date").alias("last_day"),
    )


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cust.rfm_base(star.invoices(spark, sf_dir), one_row_per_invoice=True)


@query
def rfm_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir)


@query
def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cust.rfm_scores(_base(spark, sf_dir)).select("customer_id", "R", "F", "M", "rfm_score", "rfm_total")


@query
def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cust.rfm_segments(cust.rfm_scores(_base(spark, sf_dir))).select(
        "customer_id", "recency", "frequency", "monetary", "avg_order_value", "total_items",
        "R", "F", "M", "rfm_score", "rfm_total", "segment",
    )


@query
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.value_counts(cust.rfm_segments(cust.rfm_scores(_base(spark, sf_dir))), "segment")


@query
def repeat_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cust.repeat_summary(star.invoices(spark, sf_dir))


@query
def clv_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cust.add_linear_clv(_base(spark, sf_dir)).select(
        "customer_id", "clv_historical", "clv_projected_12m", "clv_model_type",
        "weekly_purchase_rate", "lifespan_weeks",
    )


def _customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segmented customers with linear value and a churn score by formula, so that SQL can
    repeat the boards; ``customer_summary`` holds the modelled scores."""
    segments = cust.rfm_segments(cust.rfm_scores(_base(spark, sf_dir)))
    score = F.bround(F.col("recency") / (F.col("recency") + CustomerConfig().churn_days), 3)
    return stage(
        cust.add_linear_clv(segments).withColumn("churn_risk_score", score).withColumn(
            "churn_risk", churn_tier(F.col("churn_risk_score"))
        ),
        "customer-table",
    )


@query
def churn_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.value_counts(_customer_table(spark, sf_dir), "churn_risk")


@query
def segment_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.segment_board(_customer_table(spark, sf_dir))


@query
def top_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.top_segments(_customer_table(spark, sf_dir))


@query
def customer_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.customer_kpis(_customer_table(spark, sf_dir))


@query
def retention_quadrant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.retention_quadrant(_customer_table(spark, sf_dir)).select(
        "customer_id", "segment", "churn_risk_score", "clv_projected_12m", "quadrant"
    )


@query
def customer_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = bounded_sample(_customer_table(spark, sf_dir), ["customer_id"], 600)
    return sample.select("customer_id", "segment", "churn_risk_score", "clv_projected_12m")


# ---- forecast ------------------------------------------------------------------------

@query
def forecast_recursion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Panel(spark, sf_dir).forecast()


@query
def forecast_true_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Panel(spark, sf_dir).forecast("true_history")


@query
def forecast_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Panel(spark, sf_dir).valued_forecast


@query
def forecast_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.forecast_weeks(Panel(spark, sf_dir).valued_forecast)


@query
def forecast_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.forecast_summary(Panel(spark, sf_dir).valued_forecast)


@query
def forecast_by_store_cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.store_category_weeks(Panel(spark, sf_dir).valued_forecast)


@query
def store_category_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.store_category_block(Panel(spark, sf_dir).valued_forecast)


@query
def top_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.top_products(Panel(spark, sf_dir).valued_forecast, 5)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Panel(spark, sf_dir)
    return p.scorer.score(temporal_split(p.features, config=SPLIT))


@query
def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression_metrics(_scored(spark, sf_dir).where("split <> 'Train'"))


@query
def category_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression_metrics(_scored(spark, sf_dir).where("split = 'Test'"), ["cat_id"])


# ---- revenue reports -----------------------------------------------------------------

@query
def weekly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly revenue of the top products only, the scope of the forecast."""
    p = Panel(spark, sf_dir)
    kept = p.lines.join(F.broadcast(p.top.select("product_id")), "product_id", "left_semi")  # TOP_N rows
    return rep.weekly_revenue(rep.daily_revenue(kept), 52)


@query
def weekly_revenue_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.weekly_revenue(rep.daily_revenue(star.panel_lines(spark, sf_dir)), None)


@query
def revenue_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.revenue_kpis(rep.weekly_revenue(rep.daily_revenue(star.panel_lines(spark, sf_dir)), 52))


@query
def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.monthly_revenue(rep.daily_revenue(star.panel_lines(spark, sf_dir)), 24)


@query
def region_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.state_share(rep.daily_revenue(star.panel_lines(spark, sf_dir)))


@query
def revenue_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.revenue_grains(rep.daily_revenue(star.panel_lines(spark, sf_dir)))


@query
def report_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report table that needs no trained model, as one JSON object."""
    p = Panel(spark, sf_dir)
    p.features = stage(p.features, "features")  # read by three sections
    people = _customer_table(spark, sf_dir)
    cover = stage(p.inventory, "cover")
    ahead = p.valued_forecast
    weekly = stage(rep.weekly_revenue(p.daily, 52), "weekly-revenue")
    scored = p.scorer.score(temporal_split(p.features, config=SPLIT).where("split <> 'Train'"))
    grains = rep.revenue_grains(p.daily)
    return rep.report_payload({
        "total": (grains.where("grain = 'total'"), ["revenue"]),
        "stores": (store_names(spark, sf_dir), ["store_id", "name"], ["store_id"]),
        "model_metrics": (regression_metrics(scored), ["split", "r2", "mae", "rmse", "mape"], ["split"]),
        "revenue": (rep.revenue_kpis(weekly), ["this_week", "wow_pct", "last_four_weeks"]),
        "weekly": (weekly, ["label", "revenue"], ["week"]),
        "monthly": (rep.monthly_revenue(p.daily, 24), ["label", "revenue", "growth_pct"], ["month"]),
        "states": (rep.state_share(p.daily), ["state", "share_pct"], ["state"]),
        "forecast": (rep.forecast_summary(ahead), ["total", "weekly_mean", "peak_week"]),
        "forecast_weeks": (rep.forecast_weeks(ahead), ["label", "revenue"], ["forecast_week"]),
        "store_category": (rep.store_category_block(ahead), ["store_id", "cat_id", "revenue", "avg_qty", "peak_week"],
                           ["store_id", "cat_id"]),
        "top_products": (rep.top_products(ahead, 5), ["name", "cat_id", "revenue"], ["rank"]),
        "inventory": (stock.status_counts(cover), ["critical", "warning", "safe", "total", "safe_pct"]),
        "category_cover": (stock.category_cover(cover), ["cat_id", "mean_weeks"], ["cat_id"]),
        "critical_by_store": (stock.critical_by_store(cover, p.stores), ["store_id", "critical"], ["store_id"]),
        "critical_items": (stock.critical_items(cover, p.prices),
                           ["rank", "product", "store_id", "weeks_to_stockout", "demand", "price", "priority"], ["rank"]),
        "customers": (rep.customer_kpis(people), ["customers", "avg_clv", "median_clv", "high_risk", "revenue_at_risk",
                                                   "champions", "clv_model"]),
        "segments": (rep.segment_board(people), ["segment", "customers", "revenue", "colour"], ["segment"]),
        "value_by_risk": (bounded_sample(rep.retention_quadrant(people), ["customer_id"], 600),
                          ["segment", "churn_risk_score", "clv_projected_12m"], ["customer_id"]),
    })


@query
def stream_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Further calls in a session go on from where the last one ended."""
    place = f"{scratch_dir(spark)}/weekly-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    return resume_weekly_totals(spark, sf_dir, f"{place}/totals", f"{place}/checkpoint", "events.parquet")
