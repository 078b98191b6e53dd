"""Weekly panel to model features.

Every lag and rolling column shares one window (partition: series, order: week), so Spark
plans a single exchange, sort and Window node for all of them. A partition is one series:
a row per week, whatever the size of the sales.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.config import FEATURES, LAGS, ROLLING
from tillwise.functions.columns import add_weeks, calendar_parts, clip, flag
from tillwise.operators.calendar import state_snap_days
from tillwise.operators.joins import dim_join
from tillwise.operators.panel import SERIES

TINY = 1e-6


def _spec(keys: Sequence[str], order: str) -> W:
    return W.partitionBy(*keys).orderBy(order)


def add_lags(
    df: DataFrame, column: str = "quantity", lags: Sequence[int] = LAGS,
    keys: Sequence[str] = SERIES, order: str = "week",
) -> DataFrame:
    """Values of earlier rows of the same series."""
    spec = _spec(keys, order)
    return df.withColumns({f"lag_{k}": F.lag(column, k).over(spec).cast("double") for k in lags})


def add_rolling(
    df: DataFrame, column: str = "quantity", windows: Sequence[int] = ROLLING,
    keys: Sequence[str] = SERIES, order: str = "week",
) -> DataFrame:
    """Mean and sample deviation of the rows before this one, never of another series.

    With fewer than two earlier rows the deviation is 0.
    """
    spec, out = _spec(keys, order), {}
    for size in windows:
        frame = spec.rowsBetween(-size, -1)
        out[f"rolling_mean_{size}"] = F.avg(column).over(frame)
        out[f"rolling_std_{size}"] = F.coalesce(F.stddev_samp(column).over(frame), F.lit(0.0))
    return df.withColumns(out)


def add_yoy(
    df: DataFrame, column: str = "quantity", keys: Sequence[str] = SERIES, order: str = "week"
) -> DataFrame:
    """Mean of the last four weeks over that of the same weeks a year ago, within 0..5."""
    spec = _spec(keys, order)
    now = F.avg(column).over(spec.rowsBetween(-4, -1))
    ago = F.avg(column).over(spec.rowsBetween(-56, -53))
    return df.withColumn("yoy_growth", clip(now / (ago + TINY), 0, 5))


def add_price_features(
    df: DataFrame, price: str = "unit_price", keys: Sequence[str] = SERIES, order: str = "week"
) -> DataFrame:
    """Last price, relative change, and ratio to the median of the eight rows before."""
    spec = _spec(keys, order)
    last = F.lag(price, 1).over(spec)
    median = F.percentile(price, 0.5).over(spec.rowsBetween(-8, -1))
    return df.withColumns({
        "price_lag_1": last,
        "price_change": (F.col(price) - last) / (last + TINY),
        "price_vs_median_ratio": clip(F.col(price) / (median + TINY), 0, 5),
    })


def label_code(column: str) -> Column:
    """Codes 0..n-1 of the sorted distinct values, null for null.

    The window runs in one task; use on dimension tables, whose size does not follow the
    sales.
    """
    code = F.dense_rank().over(W.orderBy(F.col(column).asc_nulls_last())) - 1
    return F.when(F.col(column).isNotNull(), code).cast("int")


def encoded_products(products: DataFrame) -> DataFrame:
    """The top products' attributes with product, category and department codes."""
    return products.select("product_id", "dept_id", "cat_id").withColumns({
        "product_encoded": label_code("product_id"),
        "cat_encoded": label_code("cat_id"),
        "dept_encoded": label_code("dept_id"),
    })


def demand_features(
    panel: DataFrame, calendar: DataFrame, products: DataFrame, stores: Sequence[str], min_weeks: int = 52
) -> DataFrame:
    """The model table: one row per product, store and week with all 49 features.

    ``calendar`` is weekly and broadcast, a row per week; ``products`` holds the panel's
    (top) products.
    """
    spec, series = _spec(SERIES, "week"), W.partitionBy(*SERIES)
    windowed = add_price_features(add_yoy(add_rolling(add_lags(panel))))
    windowed = windowed.withColumn("weeks_since_start", F.row_number().over(spec) - 1)
    # Four full lags are required; the first four rows of a series lack one.
    complete = windowed.where("weeks_since_start >= 4").withColumn("_weeks", F.count("*").over(series))
    ranked = {s: i for i, s in enumerate(sorted(set(stores)))}
    codes = F.create_map(*[F.lit(x) for pair in ranked.items() for x in pair])
    long_enough = complete.where(F.col("_weeks") >= min_weeks).drop("_weeks")
    joined = dim_join(
        long_enough.join(F.broadcast(calendar), "week", "left"), encoded_products(products), "product_id"
    )
    return joined.withColumns({
        "state": F.substring("store_id", 1, 2),
        "store_encoded": F.try_element_at(codes, F.col("store_id")),
        **calendar_parts(F.col("week")),
        **{c: F.coalesce(c, F.lit(0.0)) for c in ("lag_8", "lag_12", "lag_52")},
        "yoy_growth": F.coalesce("yoy_growth", F.lit(1.0)),
        "days_since_last_event": F.coalesce("days_since_last_event", F.lit(365)),
    }).withColumn("snap_days", state_snap_days(F.col("state"))).withColumn(
        "snap", flag(F.col("snap_days") > 0)
    ).select(
        *SERIES, "week", "quantity", "revenue", "state", "dept_id", "cat_id", *FEATURES,
        *[c for c in calendar.columns if c.startswith("snap_days_")],
    )


def with_missing_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Features an older table lacks become 0."""
    missing = {c: F.lit(0) for c in features if c not in df.columns}
    return df.withColumns(missing) if missing else df


def inventory_base(features: DataFrame, products: DataFrame, weeks: int = 8) -> DataFrame:
    """Mean weekly units per series over the last weeks; the bound is inclusive, so the
    mean covers ``weeks`` + 1 weeks."""
    last = features.agg(F.max("week")).first()[0]
    recent = features.where(F.col("week") >= add_weeks(F.lit(last), -weeks))
    velocity = recent.groupBy(*SERIES).agg(F.avg("quantity").alias("avg_weekly_qty"))
    return dim_join(velocity, products.select("product_id", "cat_id", "dept_id"), "product_id")
