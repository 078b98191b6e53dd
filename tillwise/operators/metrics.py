"""Temporal split and error measures of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.config import SplitConfig


def temporal_split(df: DataFrame, week: str = "week", config: SplitConfig = SplitConfig()) -> DataFrame:
    """Name each row's split by date: Train, then Validation, then Test."""
    return df.withColumn(
        "split",
        F.when(F.col(week) <= F.lit(config.train_end), "Train")
        .when(F.col(week) <= F.lit(config.val_end), "Validation")
        .when(F.col(week).isNotNull(), "Test"),
    )


def bound_predictions(df: DataFrame, fallback_error: float | None = None) -> DataFrame:
    """Clip raw ``pred`` at 0 and order its interval around it.

    The upper bound is at least the prediction and the lower at least 0; the lower may
    exceed the prediction. With ``fallback_error`` the interval is the prediction plus or
    minus that error.
    """
    pred = F.greatest(F.col("pred"), F.lit(0.0))
    if fallback_error is None:
        low, high = F.col("pred_lo"), F.greatest(pred, F.col("pred_hi"))
    else:
        low, high = pred - fallback_error, pred + fallback_error
    return df.withColumns({"pred": pred, "pred_lo": F.greatest(low, F.lit(0.0)), "pred_hi": high})


def error_measures(actual: Column, pred: Column) -> list[Column]:
    """MAE, RMSE, R² and MAPE (rows with positive actual) as one-pass aggregates."""
    error = actual - pred
    spread = F.var_pop(actual)
    return [
        F.count("*").alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(actual > 0, F.abs(error) / actual)) * 100).alias("mape"),
        F.when(spread > 0, 1 - F.avg(error * error) / spread).alias("r2"),
    ]


def regression_metrics(scored: DataFrame, by: Sequence[str] = ("split",), actual: str = "quantity") -> DataFrame:
    """Error measures and interval coverage in percent per group, clipping scores at 0.

    R² is null where the actual is constant. The interval is clipped but not reordered.
    """
    y = F.col(actual).cast("double")
    clipped = {c: F.greatest(F.col(c), F.lit(0.0)) for c in ("pred", "pred_lo", "pred_hi") if c in scored.columns}
    rows = scored.withColumns(clipped)
    measures = error_measures(y, F.col("pred"))
    if "pred_lo" in scored.columns:
        inside = y.between(F.col("pred_lo"), F.col("pred_hi")).cast("int")
        measures.append((F.avg(inside) * 100).alias("interval_coverage_80pct"))
    return rows.groupBy(*by).agg(*measures)
