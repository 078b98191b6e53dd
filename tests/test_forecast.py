"""The recursion against a plain loop, in both rolling modes, beyond the calendar too."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.operators import calendar as cal
from tillwise.operators import features as feat
from tillwise.operators import forecast as fc
from tillwise.sources.star import calendar_days

START = date(2015, 1, 5)
WEIGHTS = {"lag_1": 0.4731, "lag_4": 0.2113, "lag_52": 0.1517, "rolling_mean_8": 0.1013, "rolling_std_4": 0.0531,
           "has_event": 1.25, "snap_days": 0.31, "days_since_last_event": 0.013, "price_vs_median_ratio": 0.7,
           "weeks_since_start": 0.011, "is_month_end": 0.37}
LOW, HIGH = {"pred": 0.8}, {"pred": 1.2}


@pytest.fixture(scope="module")
def inputs(spark):
    rng = np.random.default_rng(9)
    rows = [
        (p, s, START + timedelta(weeks=i), int(rng.integers(0, 40)), 0.0, float(rng.integers(90, 110)) / 10)
        for p in ("FOODS_1_1", "FOODS_1_2") for s in ("CA_1", "TX_1") for i in range(64)
    ]
    panel = spark.createDataFrame(rows, "product_id string, store_id string, week date, quantity long, revenue double, unit_price double")
    days = calendar_days(START, START + timedelta(weeks=69, days=6), spark)  # six weeks beyond the data
    products = spark.createDataFrame([(p, "FOODS_1", "FOODS") for p in ("FOODS_1_1", "FOODS_1_2")], "product_id string, dept_id string, cat_id string")
    weekly = cal.weekly_calendar(days)
    return feat.demand_features(panel, weekly, products, ["CA_1", "TX_1"]), days, weekly


def loop(frame, weekly, snap, rolling):
    """The recursion for every series, one step and one week at a time."""
    weekly, out = weekly.set_index("week"), []
    for (p, s), part in frame.groupby(["product_id", "store_id"]):
        part = part.sort_values("week")
        row, known = part.iloc[-1].to_dict(), dict(zip(part.week, part.quantity.astype(float)))
        actual, predictions, last = dict(known), [], part.week.iloc[-1]
        seed = [row[f"lag_{k}"] for k in (1, 2, 3, 4, 8, 12)]
        past = part.quantity.astype(float).tolist()[::-1]
        for step in range(1, 13):
            week = last + timedelta(weeks=step)
            if week in weekly.index:
                for name in ("has_event", "has_major_holiday", "days_since_last_event"):
                    row[name] = weekly.loc[week, name]
                row["snap_days"] = weekly.loc[week, f"snap_days_{s[:2]}"]
            else:
                row["has_event"] = row["has_major_holiday"] = 0
                row["snap_days"] = snap[f"snap_days_{s[:2]}"]
            row["is_month_end"] = int((week + timedelta(weeks=1)).month != week.month)
            row["weeks_since_start"] += 1
            for k in (1, 4, 52):
                row[f"lag_{k}"] = known.get(week - timedelta(weeks=k), 0.0)
            if step > 1:
                values = predictions[::-1] + (seed if rolling == "seed_deque" else past)
                values, lost = values[:12], int(rolling == "true_history")
                row["rolling_mean_8"], row["rolling_std_4"] = np.mean(values[:8]), np.std(values[:4], ddof=lost)
                row["price_vs_median_ratio"] = 1.0
            pred = max(0.0, sum(w * float(row[n]) for n, w in WEIGHTS.items()))
            known[week] = pred
            predictions.append(pred)
            out.append((p, s, week, round(pred, 1), int(row["has_event"]), round(float(row["snap_days"]), 1)))
        assert actual.keys() < known.keys()
    return pd.DataFrame(out, columns=["product_id", "store_id", "forecast_week", "qty", "event", "snap"])


@pytest.mark.parametrize("rolling", ["seed_deque", "true_history"])
def test_recursion(inputs, rolling):
    features, days, weekly = inputs
    scorer = fc.LinearScorer(WEIGHTS, LOW, HIGH)
    got = fc.forecast(features, days, weekly, scorer, rolling=rolling).toPandas()
    got = got.sort_values(["product_id", "store_id", "forecast_week"]).reset_index(drop=True)
    want = loop(features.toPandas(), weekly.toPandas(), cal.average_snap(days).first().asDict(), rolling)
    assert len(got) == 4 * 12
    assert np.allclose(got.forecast_qty, want.qty, atol=0.051) and (got.forecast_week == want.forecast_week).all()
    assert np.abs(got.forecast_qty - want.qty).mean() < 0.01
    assert (got.has_event_flag == want.event).all() and np.allclose(got.snap_days, want.snap)
    assert (got.forecast_lower >= 0).all() and (got.forecast_upper >= got.forecast_qty).all()


def test_fallback_interval(inputs):
    features, days, weekly = inputs
    got = fc.forecast(features, days, weekly, fc.LinearScorer(WEIGHTS, LOW, HIGH), horizon=2, fallback_error=3.0).toPandas()
    assert len(got) == 8
    assert np.allclose(got.forecast_upper - got.forecast_qty, 3, atol=0.051)


def test_unknown_mode(inputs):
    with pytest.raises(ValueError, match="rolling"):
        fc.forecast(*inputs, fc.LinearScorer(WEIGHTS, LOW, HIGH), rolling="x")


def test_short_series_are_dropped(spark, inputs):
    _, days, weekly = inputs
    rows = [("FOODS_1_1", "CA_1", START + timedelta(weeks=i), 1, 0.0, 1.0) for i in range(55)]
    rows += [("FOODS_1_1", "TX_1", START + timedelta(weeks=i), 1, 0.0, 1.0) for i in range(56)]
    panel = spark.createDataFrame(rows, "product_id string, store_id string, week date, quantity long, revenue double, unit_price double")
    products = spark.createDataFrame([("FOODS_1_1", "FOODS_1", "FOODS")], "product_id string, dept_id string, cat_id string")
    got = feat.demand_features(panel, weekly, products, ["CA_1", "TX_1"])
    assert [tuple(r) for r in got.groupBy("store_id").agg(F.count("*")).collect()] == [("TX_1", 52)]
