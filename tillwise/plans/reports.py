"""Report tables: revenue, forecast, model, inventory and customer boards, and the payload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.config import SEGMENT_COLOURS
from tillwise.functions.columns import constant_map, money_mean, money_sum, month_start, product_label, week_start
from tillwise.operators.ranks import exact_quantiles
from tillwise.staging import stage


# Ranges of weeks a viewer picks from; None keeps all.
WEEK_RANGES = {"Last 26 weeks": 26, "Last 52 weeks": 52, "All time": None}


# ---- revenue -------------------------------------------------------------------------

def valid_stores(df: DataFrame, stores: DataFrame | None) -> DataFrame:
    """Rows of the stores in the column ``store_id`` of ``stores``; all rows without a list."""
    return df if stores is None else df.join(stores.select("store_id"), "store_id", "left_semi")


def daily_revenue(lines: DataFrame, day: str = "order_date", stores: DataFrame | None = None) -> DataFrame:
    """Revenue per valid store and day: the one pass over the lines behind every revenue report.

    The stores are filtered here, once, so that all reports add up to the same total.
    """
    daily = lines.where(F.col(day).isNotNull()).groupBy("store_id", F.col(day).alias("day")).agg(
        money_sum(F.col("quantity") * F.col("unit_price")).alias("revenue")
    )
    return valid_stores(daily, stores)


def state_of(store: Column) -> Column:
    """The state a store id starts with."""
    return F.substring(store, 1, 2)


def revenue_grains(daily: DataFrame) -> DataFrame:
    """Total, per state, per week and per month in one pass over the daily revenue."""
    grains = daily.select(
        state_of(F.col("store_id")).alias("state"), "revenue", week_start(F.col("day")).alias("week"), month_start(F.col("day")).alias("month")
    )
    sets = [[], [F.col("state")], [F.col("week")], [F.col("month")]]
    totals = grains.groupingSets(sets, "state", "week", "month").agg(
        F.grouping_id().alias("_g"), money_sum(F.col("revenue")).alias("revenue")
    )
    # Bits of the grouping id: state 4, week 2, month 1; a set bit is aggregated away.
    name = F.when(F.col("_g") == 7, "total").when(F.col("_g") == 3, "state") \
        .when(F.col("_g") == 5, "week").otherwise("month")
    return totals.select(name.alias("grain"), "state", "week", "month", "revenue")


def change_pct(df: DataFrame, order: str, value: str, into: str) -> DataFrame:
    """Percent change to the row before; the frame has one row per period."""
    before = F.lag(value, 1).over(W.orderBy(order))
    return df.withColumn(into, F.try_divide(F.col(value) - before, before) * 100)


def last_periods(df: DataFrame, order: str, n: int | None) -> DataFrame:
    """The last ``n`` rows in ``order``, or all."""
    return df if n is None else df.orderBy(F.desc(order)).limit(n)


def weekly_revenue(daily: DataFrame, last: int | None = 52) -> DataFrame:
    """Revenue per week with week-over-week change and label."""
    weekly = daily.groupBy(week_start(F.col("day")).alias("week")).agg(money_sum(F.col("revenue")).alias("revenue"))
    return last_periods(change_pct(weekly, "week", "revenue", "wow_pct"), "week", last).withColumn(
        "label", F.date_format("week", "dd MMM ''yy")
    )


def revenue_kpis(weekly: DataFrame) -> DataFrame:
    """The newest week, its change, and the sum of the last four weeks; one row."""
    newest = last_periods(weekly, "week", 4)
    return newest.agg(
        F.max_by("revenue", "week").alias("this_week"), F.max_by("wow_pct", "week").alias("wow_pct"),
        money_sum(F.col("revenue")).alias("last_four_weeks"),
    )


def monthly_revenue(daily: DataFrame, last: int | None = 24) -> DataFrame:
    """Revenue per month with month-over-month growth and label."""
    monthly = daily.groupBy(month_start(F.col("day")).alias("month")).agg(money_sum(F.col("revenue")).alias("revenue"))
    return last_periods(change_pct(monthly, "month", "revenue", "growth_pct"), "month", last).withColumn(
        "label", F.date_format("month", "MMM ''yy")
    )


def state_share(daily: DataFrame, digits: int = 1) -> DataFrame:
    """Revenue per state and its share of all, in percent."""
    states = daily.groupBy(state_of(F.col("store_id")).alias("state")).agg(money_sum(F.col("revenue")).alias("revenue"))
    share = F.try_divide("revenue", F.sum("revenue").over(W.partitionBy())) * 100  # a row per state
    return states.withColumn("share_pct", F.bround(share, digits))


# ---- forecast ------------------------------------------------------------------------

def forecast_slice(forecasts: DataFrame, store: str | None = None, category: str | None = None) -> DataFrame:
    """The forecast of one store and / or category, as a viewer picks them."""
    out = forecasts if store is None else forecasts.where(F.col("store_id") == store)
    return out if category is None else out.where(F.col("cat_id") == category)


def forecast_weeks(forecasts: DataFrame) -> DataFrame:
    """Forecast revenue per week with its position label."""
    weekly = forecasts.groupBy("forecast_week").agg(
        money_sum(F.col("forecast_revenue")).alias("revenue"),
        money_sum(F.col("forecast_revenue_lower")).alias("revenue_lower"),
        money_sum(F.col("forecast_revenue_upper")).alias("revenue_upper"),
    )
    place = F.row_number().over(W.orderBy("forecast_week"))  # a row per forecast week
    return weekly.withColumn("step", place).withColumn("label", F.concat(F.lit("W+"), F.col("step")))


def _peak(value: str, step: str = "step") -> Column:
    """Position of the highest value, the first one on a tie."""
    return F.max_by(step, F.struct(F.col(value), -F.col(step)))


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """Total and mean weekly revenue ahead and the peak week; one row."""
    return forecast_weeks(forecasts).agg(
        money_sum(F.col("revenue")).alias("total"), money_mean(F.col("revenue")).alias("weekly_mean"), _peak("revenue").alias("peak_week")
    )


def store_category_weeks(forecasts: DataFrame) -> DataFrame:
    """Forecast per store, category and week. Bounds are sums of bounds, not a joint
    interval. ``high_qty`` is the quantity raised to its group's median week at least,
    ``base_qty`` the rest to the quantity, so never positive."""
    group = ["store_id", "cat_id"]
    weekly = forecasts.groupBy(*group, "forecast_week").agg(
        money_sum(F.col("forecast_qty")).alias("qty"), money_sum(F.col("forecast_lower")).alias("qty_lower"),
        money_sum(F.col("forecast_upper")).alias("qty_upper"), money_sum(F.col("forecast_revenue")).alias("revenue"),
    )
    # A partition holds the forecast weeks of one store and category.
    median = F.percentile("qty", 0.5).over(W.partitionBy(*group))
    step = F.row_number().over(W.partitionBy(*group).orderBy("forecast_week"))
    high = F.greatest("qty", "median_qty")
    return weekly.withColumns({"step": step, "median_qty": median}).withColumns({
        "high_qty": high, "base_qty": F.col("qty") - high,
    })


def store_category_block(forecasts: DataFrame) -> DataFrame:
    """Per store and category: revenue, mean weekly quantity and peak week."""
    return store_category_weeks(forecasts).groupBy("store_id", "cat_id").agg(
        money_sum(F.col("revenue")).alias("revenue"), money_mean(F.col("qty")).alias("avg_qty"), _peak("qty").alias("peak_week"),
        F.count("*").cast("int").alias("weeks"),
    )


def top_products(forecasts: DataFrame, n: int = 5) -> DataFrame:
    """Products of highest forecast revenue with rank and readable name."""
    order = [F.desc("revenue"), F.asc("product_id")]
    top = forecasts.groupBy("product_id", "cat_id").agg(money_sum(F.col("forecast_revenue")).alias("revenue")) \
        .orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(W.orderBy(*order))).withColumn(
        "name", product_label(F.col("product_id"), F.col("cat_id"))
    )


def model_card(metrics: DataFrame, importance: DataFrame, n: int = 10, training: Mapping[str, float] | None = None) -> DataFrame:
    """Error measures of both held-out splits, the most important features and facts of the ``training``."""
    found = {r["split"] for r in metrics.select("split").distinct().collect()}
    missing = {"Validation", "Test"} - found
    if missing:
        raise ValueError(f"metrics lack the splits {sorted(missing)}")
    names = ["r2", "mae", "rmse", "mape"]
    measures = metrics.where(F.col("split").isin("Validation", "Test")).unpivot(
        ["split"], [F.col(c).cast("double").alias(c) for c in names], "name", "value"
    ).select(F.col("split").alias("section"), "name", "value")
    top = importance.orderBy(F.desc("importance"), "feature").limit(n).select(
        F.lit("importance").alias("section"), F.col("feature").alias("name"), F.col("importance").alias("value")
    )
    facts = [("training", name, float(value)) for name, value in (training or {}).items()]
    told = metrics.sparkSession.createDataFrame(facts, "section string, name string, value double")
    return measures.unionByName(top).unionByName(told)


# ---- customers -----------------------------------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column with few values, and their share in percent."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share_pct", F.col("n") / F.sum("n").over(W.partitionBy()) * 100)


def segment_board(customers: DataFrame) -> DataFrame:
    """Customers, revenue and colour per segment."""
    return customers.groupBy("segment").agg(
        F.count("*").alias("customers"), money_sum(F.col("monetary")).alias("revenue")
    ).withColumn("colour", F.coalesce(constant_map(F.col("segment"), SEGMENT_COLOURS), F.lit("#526070")))


def top_segments(customers: DataFrame, n: int = 5) -> DataFrame:
    """Segments of highest revenue."""
    revenue = segment_board(customers).select("segment", "revenue")
    return revenue.orderBy(F.desc("revenue"), "segment").limit(n)


def customer_kpis(customers: DataFrame) -> DataFrame:
    """Customer headline numbers in one row; the median is exact and distributed."""
    risky = F.col("churn_risk").isin("High", "Critical")
    median = exact_quantiles(customers, "clv_projected_12m", [0.5])[0]
    return customers.agg(
        F.count("*").alias("customers"),
        (money_sum(F.col("clv_projected_12m")) / F.count("clv_projected_12m")).alias("avg_clv"),
        F.lit(median).alias("median_clv"),
        F.count_if(risky).alias("high_risk"),
        money_sum(F.when(risky, F.col("clv_projected_12m"))).alias("revenue_at_risk"),
        F.count_if(F.col("segment") == "Champions").alias("champions"),
        money_sum(F.when(F.col("segment") == "Champions", F.col("monetary"))).alias("champions_revenue"),
        F.max("clv_model_type").alias("clv_model"),  # one value for all rows
    )


def retention_quadrant(
    customers: DataFrame, trim: float = 0.97, risk: float = 0.5
) -> DataFrame:
    """Customers below the trim quantile of value, each with its retention priority.

    The quadrant compares churn risk with ``risk`` and value with the median of the
    trimmed customers.
    """
    limit = exact_quantiles(customers, "clv_projected_12m", [trim])[0]
    kept = customers.where(F.col("clv_projected_12m") < limit)
    median = exact_quantiles(kept, "clv_projected_12m", [0.5])[0]
    at_risk = F.col("churn_risk_score") >= risk
    valuable = F.col("clv_projected_12m") >= F.lit(median)
    return kept.withColumn(
        "quadrant",
        F.when(at_risk & valuable, "Priority retention").when(at_risk, "Deprioritise")
        .when(valuable, "Keep engaged").otherwise("Monitor"),
    )


def best_k(diagnostics: DataFrame) -> DataFrame:
    """The number of clusters with the highest silhouette, the smaller on a tie."""
    return diagnostics.orderBy(F.desc("silhouette"), "k").limit(1)


# ---- payload -------------------------------------------------------------------------

def section(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str] = (), most: int = 100_000) -> DataFrame:
    """A small report table as one (key, JSON array) row, in the order of ``order``.

    Report tables are bounded by periods, stores, categories or a top-n; a larger table
    is an error, never cut short.
    """
    body = F.struct(*columns)
    rows = df.limit(most + 1).select(F.struct(*order, body.alias("body")).alias("r"))  # no more are gathered
    listed = rows.agg(F.sort_array(F.collect_list("r")).alias("all"))
    guarded = F.when(F.size("all") <= most, F.col("all")).otherwise(
        F.raise_error(F.lit(f"report section {key} has more than {most} rows"))
    )
    return listed.select(
        F.lit(key).alias("key"), F.to_json(F.transform(guarded, lambda r: r["body"]), {"ignoreNullFields": "false"}).alias("json")
    )


def report_payload(sections: Mapping[str, tuple]) -> DataFrame:
    """All report tables as one JSON object: key -> (table, columns[, order]) per section."""
    parts = [section(table, key, *rest) for key, (table, *rest) in sections.items()]
    rows = stage(reduce(DataFrame.unionByName, parts), "payload")
    entry = F.sort_array(F.collect_list(F.struct("key", "json")))
    text = F.concat_ws(", ", F.transform(entry, lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["json"])))
    return rows.agg(F.concat(F.lit("{"), text, F.lit("}")).alias("payload"))
