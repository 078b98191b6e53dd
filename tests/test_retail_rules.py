"""Small frames with hand-written expectations for the panel, calendar and report rules."""

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.config import FEATURES
from tillwise.functions import columns as c
from tillwise.operators import calendar as cal
from tillwise.operators import customers as cust
from tillwise.operators import features as feat
from tillwise.operators import inventory as inv
from tillwise.operators import metrics, panel, sales
from tillwise.plans import queries
from tillwise.plans import reports as rep

MONDAY = date(2015, 1, 5)


def weeks(n, start=MONDAY):
    return [start + timedelta(weeks=i) for i in range(n)]


def one(df, expr):
    return df.select(expr.alias("x")).first().x


def test_weeks_start_on_monday(spark):
    days = [date(2015, 12, 31), date(2016, 1, 3), date(2016, 1, 4)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w for r in df.select(c.week_start(F.col("d")).alias("w")).collect()]
    assert got == [date(2015, 12, 28), date(2015, 12, 28), date(2016, 1, 4)]


def test_feature_list_is_complete():
    assert len(FEATURES) == 49 == len(set(FEATURES))


def test_gaps_are_filled_forward_then_back(spark):
    prices = {"a": [0, 5, 0, 0, 7, 0], "z": [0] * 6}
    rows = [(p, "s", w, float(x)) for p, xs in prices.items() for w, x in zip(weeks(6), xs)]
    df = spark.createDataFrame(rows, "product_id string, store_id string, week date, unit_price double")
    got = panel.fill_forward_back(df, "unit_price", panel.SERIES, "week").toPandas().sort_values(["product_id", "week"])
    assert got[got.product_id == "a"].unit_price.tolist() == [5, 5, 5, 5, 7, 7]
    assert got[got.product_id == "z"].unit_price.isna().all()


def lines(spark, rows):
    return spark.createDataFrame(rows, "product_id string, store_id string, order_date date, quantity long, unit_price double")


def test_panel_is_dense_and_keeps_units(spark):
    rows = [
        ("a", "CA_1", MONDAY, 2, 3.0), ("a", "CA_1", MONDAY + timedelta(days=6), 1, 5.0),
        ("a", "CA_1", MONDAY + timedelta(weeks=3), 4, 5.0), ("b", "TX_1", MONDAY + timedelta(weeks=1), 9, 2.0),
        ("c", "CA_1", MONDAY, 1, 0.5), ("a", "long_store", MONDAY, 7, 1.0),
    ]
    df = lines(spark, rows)
    top, coverage = panel.top_n(df, "product_id", F.col("quantity") * F.col("unit_price"), 2)
    assert [r.product_id for r in top.orderBy("product_id").collect()] == ["a", "b"]
    assert coverage.first()[0] == pytest.approx(56 / 56.5)
    got = panel.weekly_panel(df, top, ["CA_1", "TX_1"]).toPandas()
    assert len(got) == 2 * 2 * 4 and got.quantity.sum() == 16
    first = got[(got.product_id == "a") & (got.store_id == "CA_1")].sort_values("week")
    assert first.quantity.tolist() == [3, 0, 0, 4] and first.revenue.tolist() == [11, 0, 0, 20]
    assert first.unit_price.tolist() == [4, 4, 4, 5]
    # A series without any price takes the product's median over its filled prices.
    other = got[(got.product_id == "a") & (got.store_id == "TX_1")]
    assert other.unit_price.tolist() == [4, 4, 4, 4]


def series(spark, name, values, price=2.0):
    rows = [(name, "CA_1", w, float(v), price) for w, v in zip(weeks(len(values)), values)]
    return spark.createDataFrame(rows, "product_id string, store_id string, week date, quantity double, unit_price double")


def test_windows_never_leak_between_series(spark):
    df = series(spark, "a", [1] * 15).unionByName(series(spark, "b", [1000] * 15))
    got = feat.add_rolling(feat.add_lags(df)).toPandas()
    for name, level in (("a", 1), ("b", 1000)):
        part = got[got.product_id == name].sort_values("week")
        assert part.rolling_mean_12.isna().sum() == 1
        assert set(part.rolling_mean_12.dropna()) == {level} and set(part.rolling_std_12) == {0}
        assert part.lag_12.isna().sum() == 12 and set(part.lag_12.dropna()) == {level}


def test_rolling_deviation(spark):
    got = feat.add_rolling(series(spark, "a", [2, 4, 9, 9])).toPandas().sort_values("week")
    assert got.rolling_std_4.tolist() == pytest.approx([0, 0, np.std([2, 4], ddof=1), np.std([2, 4, 9], ddof=1)])


def test_growth_over_a_year(spark):
    got = feat.add_yoy(series(spark, "a", [10] * 57 + [500] * 8)).toPandas().sort_values("week")
    assert got.yoy_growth[:53].isna().all() and got.yoy_growth.iloc[53] == pytest.approx(1, abs=1e-6)
    assert got.yoy_growth.iloc[56] == pytest.approx(1, abs=1e-6)
    assert got.yoy_growth.iloc[-1] == 5


def test_price_features(spark):
    df = series(spark, "a", [1] * 4).withColumn("unit_price", F.expr("date_diff(week, DATE'2015-01-05') / 7 + 1"))
    got = feat.add_price_features(df).toPandas().sort_values("week")
    assert got.price_lag_1.iloc[1:].tolist() == [1, 2, 3]
    assert got.price_change.iloc[3] == pytest.approx(1 / 3, abs=1e-6)
    assert got.price_vs_median_ratio.iloc[3] == pytest.approx(2, abs=1e-5)


def events(spark, n, at):
    """``n`` weeks of days; ``at`` maps a week to its (name, type) pairs."""
    rows = []
    for i in range(7 * n):
        pairs = at.get(i // 7, []) if i % 7 == 2 else []
        names = [p for pair in (pairs + [(None, None)] * 2)[:2] for p in pair]
        rows.append((MONDAY + timedelta(days=i), *names, 1, 0, int(i % 7 == 0)))
    return spark.createDataFrame(
        rows, "date date, event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string, "
        "snap_CA int, snap_TX int, snap_WI int",
    )


def test_weekly_calendar(spark):
    at = {
        2: [("OrthodoxChristmas", "Religious"), ("Local fair", "Cultural")],
        5: [("Local fair", "Cultural")],
        6: [("Mother's day", "Cultural")],
    }
    got = cal.weekly_calendar(events(spark, 7, at)).toPandas().sort_values("week")
    assert got.days_since_last_event.tolist() == [365, 365, 0, 7, 14, 0, 0]
    assert got.n_events.tolist() == [0, 0, 2, 0, 0, 1, 1]
    assert got.has_major_holiday.tolist() == [0, 0, 1, 0, 0, 0, 1]
    assert got.event_week_before.tolist() == [0, 1, 0, 0, 0, 1, 0]
    assert got.event_week_after.tolist() == [0, 0, 0, 1, 0, 0, 0]
    assert got.is_christmas.tolist() == [0, 0, 1, 0, 0, 0, 0] and got.is_mothersday.tolist()[-1] == 1
    assert got.is_religious.sum() == 1 and got.is_cultural.sum() == 3
    assert (got.snap_days_CA == 7).all() and (got.snap_days_TX == 0).all() and (got.snap_days_WI == 1).all()
    assert got.is_month_end.tolist() == [0, 0, 0, 1, 0, 0, 0]


def test_own_state_counts(spark):
    df = spark.createDataFrame([("CA", 1, 2, 3), ("TX", 1, 2, 3), ("WI", 1, 2, 3)], "s string, snap_days_CA int, snap_days_TX int, snap_days_WI int")
    assert [r.x for r in df.select(cal.state_snap_days(F.col("s")).alias("x")).collect()] == [1, 2, 3]


def wide_rule(r, f, m):
    """The segment rules written out as disjoint regions."""
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if r >= 3 and f >= 3:
        return "Loyal customers"
    if r >= 4:
        return "New customers"
    if r == 3:
        return "Potential loyalists" if f == 2 and m >= 3 else "Needs attention"
    if r == 2 and f >= 2:
        return "At risk"
    if f >= 3:
        return "Cannot lose them"
    return "Lost" if m <= 2 else "Needs attention"


def test_all_score_triples_have_a_segment(spark):
    rows = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "r int, f int, m int")
    got = df.withColumn("s", c.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()
    assert all(x.s == wide_rule(x.r, x.f, x.m) for x in got)


def test_tier_boundaries(spark):
    scores = spark.createDataFrame([(x,) for x in (0.249, 0.25, 0.5, 0.75)], "x double")
    assert [r.t for r in scores.select(c.churn_tier(F.col("x")).alias("t")).collect()] == ["Low", "Medium", "High", "Critical"]
    base = spark.createDataFrame(
        [(f"p{i}", "CA_1", 100.0) for i in range(6)] + [("slow", "CA_1", 0.9)], "product_id string, store_id string, avg_weekly_qty double"
    )
    stock = spark.createDataFrame(
        [(f"p{i}", "CA_1", x) for i, x in enumerate([200.0, 204.0, 205.0, 206.0, 400.0, 500.0])], "product_id string, store_id string, current_stock double"
    )
    got = inv.inventory_coverage(base, stock).orderBy("product_id").collect()
    assert [r.status for r in got] == ["Critical"] * 3 + ["Warning", "Warning", "Safe"]
    counts = inv.status_counts(inv.inventory_coverage(base, stock)).first()
    assert (counts.critical, counts.warning, counts.safe, counts.total) == (3, 2, 1, 6)


def test_labels(spark):
    df = spark.createDataFrame([("FOODS_3_586", "FOODS", "CA_1", date(2015, 3, 1))], "p string, k string, s string, d date")
    assert one(df, c.product_label(F.col("p"), F.col("k"))) == "Foods · Item 586"
    assert one(df, c.product_label(F.col("p"), F.lit(""))) == "Foods · Item 586"
    assert one(df, c.store_name(F.col("s"))) == "CA_1 — California Store 1"
    assert one(df, c.order_key(F.col("s"), F.col("d"))) == "CA_1_20150301"
    assert one(df, c.constant_map(F.lit("XX"), {"CA": "West"})) is None


def test_whole_days_floor(spark):
    df = spark.createDataFrame([(datetime(2015, 1, 2, 23), datetime(2015, 1, 4, 22))], "a timestamp, b timestamp")
    assert one(df, c.whole_days(F.col("b"), F.col("a"))) == 1


def test_cleaning(spark):
    day = datetime(2011, 1, 1, 12)
    rows = [("1", None, 1, 1.0), ("2", 1, 0, 1.0), ("3", 1, -1, 1.0), ("4", 1, 1, 0.0), ("C1", 1, 1, 1.0), ("AC1", 1, 2, 1.5)]
    df = spark.createDataFrame([(i, k, day, q, p, "UK") for i, k, q, p in rows],
                               "invoice string, customer_id long, invoice_date timestamp, quantity int, price double, country string")
    kept = cust.clean_transactions(df).collect()
    assert [(r.invoice, r.revenue) for r in kept] == [("AC1", 3.0)]


@pytest.fixture(scope="module")
def buyers(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        customer = 1 if i % 3 == 0 else int(rng.integers(2, 60))  # one customer holds a third
        day = datetime(2011, 1, 1) + timedelta(hours=int(rng.integers(0, 24 * 300)))
        for _ in range(int(rng.integers(1, 4))):
            rows.append((f"{i}", customer, day, int(rng.integers(1, 9)), float(rng.integers(1, 900)) / 100, ["UK", "FR"][i % 2]))
    frame = pd.DataFrame(rows, columns=["invoice", "customer_id", "invoice_date", "quantity", "price", "country"])
    return spark.createDataFrame(frame), frame


def test_customer_measures(buyers):
    df, frame = buyers
    frame = frame.assign(revenue=frame.quantity * frame.price)
    want = frame.groupby("customer_id").agg(
        last=("invoice_date", "max"), first=("invoice_date", "min"), frequency=("invoice", "nunique"),
        monetary=("revenue", "sum"), avg_order_value=("revenue", "mean"), countries=("country", "nunique"),
    )
    end = frame.invoice_date.max() + timedelta(weeks=1)
    bills = cust.invoice_totals(cust.clean_transactions(df))
    for promise in (False, True):
        got = cust.rfm_base(bills, promise).toPandas().set_index("customer_id").sort_index()
        assert (got.recency == (end - want["last"]).dt.days).all()
        assert (got.frequency == want.frequency).all() and (got.countries == want.countries).all()
        assert np.allclose(got.monetary, want.monetary) and np.allclose(got.avg_order_value, want.avg_order_value)
        assert np.allclose(got.lifespan_weeks, ((want["last"] - want["first"]).dt.days / 7).clip(lower=1))


def test_every_customer_has_one_segment(buyers):
    df, frame = buyers
    got = cust.customer_rfm(df).toPandas()
    assert sorted(got.customer_id) == sorted(frame.customer_id.unique())
    assert got[["R", "F", "M"]].isin(range(1, 6)).all().all() and got.segment.notna().all()


def test_repeat_summary(spark):
    day = lambda n: datetime(2015, 1, 5) + timedelta(days=n)
    rows = [(1, "a", day(0), 10.0), (1, "b", day(1), 5.0), (1, "c", day(14), 8.0), (1, "d", day(21), 4.0), (2, "e", day(8), 3.0)]
    bills = spark.createDataFrame(rows, "customer_id long, invoice string, invoice_date timestamp, revenue double")
    got = cust.repeat_summary(bills).toPandas().set_index("customer_id")
    assert got.loc[1, ["frequency", "recency", "T", "monetary_value"]].tolist() == [2, 3, 4, 6]
    assert got.loc[2, ["frequency", "recency", "T", "monetary_value"]].tolist() == [0, 0, 3, 0]


def test_wide_sales_to_tables(spark):
    rng = np.random.default_rng(1)
    days, items, shops = 30, [f"FOODS_1_{i}" for i in range(6)], ["CA_1", "TX_1"]
    rows = [(f"{i}_{s}", i, "FOODS_1", "FOODS", s, s[:2], *map(int, rng.integers(0, 3, days))) for i in items for s in shops]
    names = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", *[f"d_{d + 1}" for d in range(days)]]
    wide = pd.DataFrame(rows, columns=names)
    calendar = pd.DataFrame({"d": names[6:], "date": [MONDAY + timedelta(days=i) for i in range(days)]})
    calendar["wm_yr_wk"] = [11500 + i // 7 for i in range(days)]
    for name in ("event_name_1", "event_type_1"):
        calendar[name] = [None if i % 9 else "Easter" for i in range(days)]
    for name in ("snap_CA", "snap_TX", "snap_WI"):
        calendar[name] = 1
    prices = pd.DataFrame(
        [(s, i, w, float(rng.integers(100, 900)) / 100) for s in shops for i in items[:-1] for w in range(11500, 11505) if rng.random() < 0.7],
        columns=["store_id", "item_id", "wm_yr_wk", "sell_price"],
    )
    got = sales.build_sales_tables(
        spark.createDataFrame(wide), spark.createDataFrame(calendar), spark.createDataFrame(prices), 10, {"CA": "West", "TX": "South"}
    )
    long = wide.melt(id_vars=names[:6], var_name="d", value_name="quantity").query("quantity > 0")
    long = long.merge(calendar, on="d").merge(prices, how="left", on=["store_id", "item_id", "wm_yr_wk"])
    long["chunk"] = (long.d.str[2:].astype(int) - 1) // 10
    by_item = long.groupby(["store_id", "chunk", "item_id"]).sell_price.transform("median")
    long["price"] = long.sell_price.fillna(by_item)
    long["price"] = long.price.fillna(long.groupby(["store_id", "chunk"]).price.transform("median"))
    items_got = got["line_items"].toPandas()
    assert len(items_got) == len(long) and np.isclose(items_got.unit_price.sum(), long.price.sum())
    orders = got["orders"].toPandas().set_index("order_id")
    long["order_id"] = long.store_id + "_" + pd.to_datetime(long.date).dt.strftime("%Y%m%d")
    want = long.assign(t=long.quantity * long.price).groupby("order_id").agg(t=("t", "sum"), u=("quantity", "sum"), n=("item_id", "nunique"))
    orders = orders.loc[want.index]
    assert np.allclose(orders.total_amount, want.t) and (orders.total_units == want.u).all() and (orders.n_items == want.n).all()
    products = got["products"].toPandas().set_index("product_id")
    assert len(products) == 6 and np.isnan(products.loc[items[-1], "median_price"])
    assert np.allclose(products.median_price.dropna().sort_index(), prices.groupby("item_id").sell_price.median())
    assert {(r.store_id, r.region) for r in got["stores"].collect()} == {("CA_1", "West"), ("TX_1", "South")}


def test_error_measures(spark):
    rows = [("a", 0.0, 1.0, 0.0, 2.0), ("a", 4.0, 2.0, 3.0, 5.0), ("a", 8.0, -1.0, 0.0, 1.0), ("b", 5.0, 5.0, 5.0, 5.0), ("b", 5.0, 4.0, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "split string, quantity double, pred double, pred_lo double, pred_hi double")
    got = {r.split: r for r in metrics.regression_metrics(df).collect()}
    a = got["a"]
    assert a.mae == pytest.approx((1 + 2 + 8) / 3) and a.rmse == pytest.approx(((1 + 4 + 64) / 3) ** 0.5)
    assert a.mape == pytest.approx((0.5 + 1) / 2 * 100) and a.interval_coverage_80pct == pytest.approx(200 / 3)
    assert a.r2 == pytest.approx(1 - 69 / (3 * np.var([0, 4, 8]))) and got["b"].r2 is None


def test_prediction_bounds(spark):
    df = spark.createDataFrame([(-2.0, -5.0, -1.0), (3.0, 4.0, 2.0)], "pred double, pred_lo double, pred_hi double")
    assert [tuple(r) for r in metrics.bound_predictions(df).collect()] == [(0, 0, 0), (3, 4, 3)]
    assert [tuple(r) for r in metrics.bound_predictions(df, 2.0).collect()] == [(0, 0, 2), (3, 1, 5)]


def test_split_is_by_date(spark):
    df = spark.createDataFrame([(date(2014, 12, 31),), (date(2015, 1, 1),), (date(2016, 1, 1),)], "week date")
    assert [r.split for r in metrics.temporal_split(df).collect()] == ["Train", "Validation", "Test"]


def test_all_reports_take_the_same_stores(spark):
    day = weeks(1)[0]
    lines = spark.createDataFrame(
        [("CA_1", day, 1.0, 10.0), ("CA_10", day, 1.0, 5.0), ("store", day, 1.0, 7.0)],
        "store_id string, order_date date, quantity double, unit_price double",
    )
    stores = spark.createDataFrame([("CA_1",), ("CA_10",)], "store_id string")
    daily = rep.daily_revenue(lines, stores=stores)
    total = rep.revenue_grains(daily).agg({"revenue": "max"}).first()[0]
    assert total == rep.monthly_revenue(daily).first().revenue == rep.weekly_revenue(daily).first().revenue == 15.0
    assert [(r.state, r.revenue) for r in rep.state_share(daily).collect()] == [("CA", 15.0)]


def test_money_totals_beyond_a_long_of_units(spark):
    df = spark.createDataFrame([(9e14,)] * 5 + [(-0.5,), (0.25,), (None,)], "x double")
    total, mean = df.agg(c.money_sum(F.col("x")), c.money_mean(F.col("x"))).first()
    assert total == 4.5e15 - 0.25 and mean == total / 7


def test_null_scores_hold_no_rule(spark):
    df = spark.createDataFrame([(None, 5, 5), (2, None, 2), (5, 5, 5)], "r int, f int, m int")
    got = df.select(c.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()
    assert [r[0] for r in got] == ["Needs attention", "Needs attention", "Champions"]


def test_peak_is_the_first_highest_week(spark):
    rows = [("CA_1", "FOODS", w, q, q, q, q) for w, q in zip(weeks(4), [1.0, 5.0, 5.0, 2.0])]
    df = spark.createDataFrame(rows, "store_id string, cat_id string, forecast_week date, forecast_qty double, "
                               "forecast_lower double, forecast_upper double, forecast_revenue double")
    assert rep.store_category_block(df).first().peak_week == 2
    split = rep.store_category_weeks(df).orderBy("step").collect()
    assert [(r.high_qty, r.base_qty) for r in split] == [(3.5, -2.5), (5, 0), (5, 0), (3.5, -1.5)]


def test_missing_split_is_an_error(spark):
    got = spark.createDataFrame([("Test", 1.0, 1.0, 1.0, 1.0)], "split string, r2 double, mae double, rmse double, mape double")
    with pytest.raises(ValueError, match="Validation"):
        rep.model_card(got, got)


def test_a_section_too_long_is_an_error(spark):
    with pytest.raises(Exception, match="more than 3 rows"):
        rep.section(spark.range(4), "k", ["id"], most=3).collect()


def test_slices_and_ranges(spark):
    rows = [("CA_1", "FOODS", 1), ("CA_1", "HOBBIES", 2), ("TX_1", "FOODS", 3)]
    df = spark.createDataFrame(rows, "store_id string, cat_id string, n int")
    assert [r.n for r in rep.forecast_slice(df, "CA_1", "FOODS").collect()] == [1]
    assert rep.forecast_slice(df, category="FOODS").count() == 2 and rep.forecast_slice(df).count() == 3
    periods = spark.createDataFrame([(w,) for w in weeks(60)], "week date")
    assert [rep.last_periods(periods, "week", n).count() for n in rep.WEEK_RANGES.values()] == [26, 52, 60]


def test_a_task_pivots_a_bounded_number_of_sales(spark, tmp_path, monkeypatch):
    """The wide rows of a task do not grow with the table, and the sums are those of the long form."""
    n = 2000
    id_ = F.col("id")
    lines = spark.range(n).select(
        id_.alias("l_orderkey"), (id_ % 397).alias("l_partkey"), (id_ % 4).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        (1 + id_ % 5).cast("double").alias("l_quantity"), F.lit(100.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("cast(date_add(date'1995-01-01', cast(id % 90 as int)) as timestamp_ntz)").alias("l_shipdate"),
    )
    suppliers = spark.sql("SELECT id AS s_suppkey, 's' AS s_name, cast(id AS int) AS s_nationkey, 0D AS s_acctbal FROM range(4)")
    nations = spark.sql("SELECT cast(id AS int) AS n_nationkey, 'n' AS n_name, cast(id AS int) AS n_regionkey FROM range(4)")
    for name, df in (("lineitem", lines), ("supplier", suppliers), ("nation", nations)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(sales, "PIVOT_ROWS", 50, raising=False)
    got = queries.unpivot_sales(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).toPandas()
    per_task = got.drop_duplicates(["item_id", "store_id"]).groupby("task").size()
    assert per_task.max() <= 150 and len(per_task) > 20
    long = lines.toPandas()
    long["d"] = "d_" + long.l_shipdate.dt.day.astype(str)
    long["store_id"] = [f"{('CA', 'TX', 'WI')[s % 3]}_{s}" for s in long.l_suppkey]
    wanted = long.groupby(["l_partkey", "store_id", "d"]).l_quantity.sum().astype(int)
    assert got.set_index(["item_id", "store_id", "d"]).quantity.to_dict() == wanted.to_dict()
