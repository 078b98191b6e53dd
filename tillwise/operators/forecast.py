"""Recursive weekly forecast, all series advancing together.

A step needs only the series' own row: the seed features, its last 52 quantities and the
predictions so far. So one pass over one row per series makes all steps: a small state machine
holds the series of an Arrow batch as arrays and moves them on week by week, without a shuffle, a
growing plan or a table in between.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.config import EVENT_FLAGS, FEATURES, LAGS, ROLLING
from tillwise.functions.columns import is_month_end
from tillwise.operators.calendar import average_snap
from tillwise.operators.joins import dim_join
from tillwise.operators.panel import SERIES
from tillwise.staging import stage

HORIZON = 12
HISTORY = 52
SEED_LAGS = (1, 2, 3, 4, 8, 12)
DEPTH = 12
#: Features of a coming week that only its calendar decides.
DATED = ("week_of_year", "month", "quarter", "year", "is_q4", "is_january", "is_month_end")
#: The calendar of the steps ahead, one array each.
AHEAD = (*EVENT_FLAGS, "days_since_last_event", *DATED)

#: Raw prediction and interval for a matrix of inputs in the order of ``FEATURES``, null as NaN.
ArrayScorer = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class LinearScorer:
    """Fixed weights; ``low`` and ``high`` may weigh the prediction itself under the name ``pred``."""

    weights: Mapping[str, float]
    low: Mapping[str, float]
    high: Mapping[str, float]

    def score(self, df: DataFrame) -> DataFrame:
        """Add raw ``pred``, ``pred_lo`` and ``pred_hi``."""
        terms = lambda w: " + ".join(f"{v}D * {c}" for c, v in w.items())
        first = df.selectExpr("*", f"{terms(self.weights)} AS pred")
        return first.selectExpr("*", f"{terms(self.low)} AS pred_lo", f"{terms(self.high)} AS pred_hi")

    def arrays(self) -> ArrayScorer:
        weights, low, high, place = self.weights, self.low, self.high, {c: i for i, c in enumerate(FEATURES)}

        def score(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            def total(terms: Mapping[str, float], pred: np.ndarray | None = None) -> np.ndarray:
                parts = [w * (pred if c == "pred" else x[:, place[c]]) for c, w in terms.items()]
                out = parts[0]
                for part in parts[1:]:
                    out = out + part
                return out

            pred = total(weights)
            return pred, total(low, pred), total(high, pred)

        return score


def seeds(features: DataFrame) -> DataFrame:
    """The latest row of every series with its last quantities, newest first.

    Aggregates rather than sorts; a series contributes one number per week.
    """
    columns = [c for c in ("state", "dept_id", "cat_id", *FEATURES) if c in features.columns]
    latest = F.max_by(F.struct(*columns), "week").alias("_row")
    past = F.sort_array(F.collect_list(F.struct("week", F.col("quantity").cast("double").alias("q"))), False)
    return (
        features.groupBy(*SERIES)
        .agg(F.max("week").alias("last_week"), latest, past.alias("_past"))
        .select(
            *SERIES, "last_week", "_row.*",
            F.transform(F.slice("_past", 1, HISTORY), lambda x: x["q"]).alias("_recent"),
        )
    )


def future_calendar(last_weeks: DataFrame, weekly: DataFrame, snap: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """last_week -> the calendar of the weeks ahead, one array per feature and state.

    Beyond the calendar there are no events, benefit days take the state mean, and the
    days since the last event stay at the last known value (null: that of the seed).
    """
    flags, states = list(EVENT_FLAGS), [c for c in snap.columns if c.startswith("snap_days_")]
    defaults = snap.first()  # one row
    known = weekly.select(F.col("week").alias("forecast_week"), *flags, "days_since_last_event", *states)
    ahead = (
        last_weeks.select("last_week").distinct()
        .select("last_week", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
        .withColumn("forecast_week", F.expr("date_add(last_week, 7 * step)"))
        .join(F.broadcast(known), "forecast_week", "left")  # a row per calendar week
    )
    so_far = W.partitionBy("last_week").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    week = F.col("forecast_week")
    filled = ahead.withColumns({
        **{c: F.coalesce(c, F.lit(0)) for c in flags},
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(defaults[c]).cast("double")) for c in states},
        "days_since_last_event": F.last("days_since_last_event", ignorenulls=True).over(so_far),
        "week_of_year": F.weekofyear(week), "month": F.month(week), "quarter": F.quarter(week), "year": F.year(week),
        "is_q4": F.month(week) >= 10, "is_january": F.month(week) == 1, "is_month_end": is_month_end(week),
    })
    columns = ["forecast_week", *AHEAD, *states]
    steps = filled.groupBy("last_week").agg(F.sort_array(F.collect_list(F.struct("step", *columns))).alias("_steps"))
    number = lambda c: F.col(f"_steps.{c}").cast("array<double>")
    return steps.select(
        "last_week", F.col("_steps.forecast_week").alias("_weeks"),
        *[number(c).alias(f"_ahead_{c}") for c in AHEAD], *[number(c).alias(f"_{c}") for c in states],
    )


def spread(values: np.ndarray, there: np.ndarray, lost: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each row's values by the running update, row by row alike."""
    n, mean, squares = (np.zeros(len(values)) for _ in range(3))
    for x, ok in zip(values.T, there.T, strict=True):
        step = x - mean
        moved = step / (n + 1)
        squares = np.where(ok, squares + step * (step - moved), squares)
        mean, n = np.where(ok, mean + moved, mean), n + ok
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(n > 0, mean, np.nan), np.sqrt(squares / np.where(n > lost, n - lost, np.nan))


def advance(
    x: np.ndarray, recent: np.ndarray, known: np.ndarray, ahead: Mapping[str, np.ndarray], scorer: ArrayScorer,
    horizon: int, rolling: str, fallback_error: float | None,
) -> np.ndarray:
    """Move all series on: prediction, lower and upper bound of each step (steps x 3 x series).

    ``x`` has the seed features, ``recent`` the last quantities, newest first, of which ``known``
    exist, and ``ahead`` the changing features of each step.
    """
    x, at = x.copy(), {c: i for i, c in enumerate(FEATURES)}
    start, seed_days = x[:, at["weeks_since_start"]].copy(), x[:, at["days_since_last_event"]].copy()
    if rolling == "seed_deque":
        window = x[:, [at[f"lag_{k}"] for k in SEED_LAGS]]
        there, lost = np.ones(window.shape, dtype=bool), 0
    else:
        window, there, lost = recent[:, :DEPTH], known[:, :DEPTH], 1
    out = np.empty((horizon, 3, len(x)))
    for step in range(1, horizon + 1):
        for c, values in ahead.items():
            x[:, at[c]] = values[:, step - 1]
        unseen = np.isnan(x[:, at["days_since_last_event"]])
        x[unseen, at["days_since_last_event"]] = seed_days[unseen]
        x[:, at["weeks_since_start"]] = start + step
        for k in LAGS:
            x[:, at[f"lag_{k}"]] = np.where(known[:, k - 1], recent[:, k - 1], 0.0)
        if step > 1:
            for size in ROLLING:
                mean, std = spread(window[:, :size], there[:, :size], lost)
                x[:, at[f"rolling_mean_{size}"]], x[:, at[f"rolling_std_{size}"]] = mean, std
            x[:, at["price_vs_median_ratio"]] = 1.0
        raw, low, high = scorer(x)
        pred = np.fmax(raw, 0.0)
        if fallback_error is not None:
            low, high = pred - fallback_error, pred + fallback_error
        out[step - 1] = pred, np.fmax(low, 0.0), high if fallback_error is not None else np.fmax(pred, high)
        new, yes = pred[:, None], np.ones((len(x), 1), dtype=bool)
        recent, known = np.hstack([new, recent])[:, :HISTORY], np.hstack([yes, known])[:, :HISTORY]
        window, there = np.hstack([new, window])[:, :DEPTH], np.hstack([yes, there])[:, :DEPTH]
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix, NaN for nulls and beyond the end of a list."""
    out = np.full((len(column), width), np.nan)
    for i, values in enumerate(column.to_pylist()):
        row = np.array(values or [], dtype=float)[:width]  # None becomes NaN
        out[i, : len(row)] = row
    return out


def forecast(
    features: DataFrame,
    calendar: DataFrame,
    weekly: DataFrame,
    scorer: object,
    horizon: int = HORIZON,
    rolling: str = "seed_deque",
    fallback_error: float | None = None,
) -> DataFrame:
    """``horizon`` weekly predictions with bounds for every series.

    ``calendar`` is daily (for the benefit-day means), ``weekly`` the weekly calendar; ``scorer`` has
    ``arrays()``, a scorer of matrices that travels to the tasks.
    Lags take earlier predictions where the week is forecast, else the actual, else 0.
    Quantities are rounded for output only; the exact prediction feeds the next step.
    The upper bound is at least the prediction and the lower at least 0, as in ``bound_predictions``.
    ``rolling`` keeps the window statistics of the seed's lags ("seed_deque": the seed
    week itself never enters) or takes them from the series' real past ("true_history").
    """
    if rolling not in ("seed_deque", "true_history"):
        raise ValueError(f"unknown rolling mode {rolling}")
    series = stage(seeds(features), "seeds")
    snap = average_snap(calendar)
    states = [c.removeprefix("snap_days_") for c in snap.columns]
    ahead = future_calendar(series, weekly, snap, horizon)
    own = F.coalesce(*[F.when(F.col("state") == s, F.col(f"_snap_days_{s}")) for s in states[:-1]], F.col(f"_snap_days_{states[-1]}"))
    inputs = F.array(*[F.col(c).cast("double") for c in FEATURES])
    rows = series.join(F.broadcast(ahead), "last_week", "left").select(  # a row per last week
        *SERIES, inputs.alias("_x"), F.col("_recent"), "_weeks", own.alias("_ahead_snap_days"), *[f"_ahead_{c}" for c in AHEAD]
    )
    keys, fields = len(SERIES), [f.removeprefix("_ahead_") for f in rows.columns if f.startswith("_ahead_")]
    score = scorer.arrays()
    schema = T.StructType([*rows.select(*SERIES).schema, *T._parse_datatype_string(
        "forecast_week date, pred double, pred_lo double, pred_hi double, has_event int, has_major_holiday int, snap_days double"
    )])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            recent = matrix(batch.column(keys + 1), HISTORY)
            sizes = np.array([len(v or []) for v in batch.column(keys + 1).to_pylist()])
            known = np.arange(HISTORY)[None, :] < sizes[:, None]
            coming = {c: matrix(batch.column(keys + 3 + i), horizon) for i, c in enumerate(fields)}
            moving = {**coming, "snap": np.where(np.isnan(coming["snap_days"]), np.nan, coming["snap_days"] > 0)}
            done = advance(matrix(batch.column(keys), len(FEATURES)), recent, known, moving, score, horizon, rolling, fallback_error)
            weeks = batch.column(keys + 2).to_pylist()
            row = np.tile(np.arange(n), horizon)
            numbers = lambda values: pa.array(values.reshape(-1), pa.float64(), from_pandas=True)
            columns = [
                *[batch.column(i).take(pa.array(row)) for i in range(keys)],
                pa.array([weeks[i][s] for s in range(horizon) for i in range(n)], pa.date32()),
                *[numbers(done[:, k]) for k in range(3)],
                *[pa.array(coming[c].T.reshape(-1).astype(np.int32)) for c in ("has_event", "has_major_holiday")],
                numbers(coming["snap_days"].T),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rounded = {"forecast_qty": "pred", "forecast_lower": "pred_lo", "forecast_upper": "pred_hi"}
    return rows.mapInArrow(run, schema).select(
        *SERIES, "forecast_week", *[F.bround(c, 1).alias(name) for name, c in rounded.items()],
        F.col("has_event").alias("has_event_flag"), F.col("has_major_holiday").alias("has_major_holiday_flag"),
        F.bround("snap_days", 1).alias("snap_days"),
    )


def forecast_revenue(forecasts: DataFrame, products: DataFrame) -> DataFrame:
    """Value the forecast and its bounds at each product's median price."""
    attributes = products.select("product_id", "dept_id", "cat_id", "median_price")
    priced = dim_join(forecasts, attributes, "product_id")
    return priced.withColumns({
        f"forecast_revenue{suffix}": F.col(column) * F.col("median_price")
        for suffix, column in (("", "forecast_qty"), ("_lower", "forecast_lower"), ("_upper", "forecast_upper"))
    })
