"""Demand models on the weekly features: point, interval, search and importance."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.config import FEATURES, BoostConfig
from tillwise.operators.boosting import QuantileBoost, bin_rows, fit_quantile, load_quantile, save_quantile
from tillwise.operators.forecast import ArrayScorer
from tillwise.operators.parallel import fit_all
from tillwise.sources.tables import load_params, save_models, save_params


def feature_array(features: Sequence[str] = FEATURES) -> Column:
    """The model inputs as one array of doubles, null as 0."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])


def training_rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Inputs of the training and validation rows of a split table, and nothing else."""
    return df.where(F.col("split").isin("Train", "Validation")).select(
        feature_array(features).alias("features"),
        F.col(label).cast("double").alias("label"),
        (F.col("split") == "Validation").alias("held_out"),
    ).where("label is not null")


def fit_point(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str = "quantity", config: BoostConfig = BoostConfig(), patience: int = 50
) -> QuantileBoost:
    """Boosted trees under absolute loss; Validation rows end the boosting by patience."""
    return fit_quantile(training_rows(df, features, label), 0.5, config, patience)


@dataclass
class DemandModels:
    """A point model with the two quantile models of its 80 % interval."""

    point: QuantileBoost
    low: QuantileBoost
    high: QuantileBoost
    features: Sequence[str] = FEATURES

    def score(self, df: DataFrame) -> DataFrame:
        """Add raw ``pred``, ``pred_lo`` and ``pred_hi``."""
        return df.withColumn("_x", feature_array(self.features)).withColumns(
            {"pred": self.point.predict("_x"), "pred_lo": self.low.predict("_x"), "pred_hi": self.high.predict("_x")}
        ).drop("_x")

    def arrays(self) -> ArrayScorer:
        """The scorer of the forecast: matrices in the order of ``FEATURES``, null as NaN."""
        models = [replace(m, losses=[]) for m in (self.point, self.low, self.high)]
        place = [FEATURES.index(f) for f in self.features]
        return lambda x: tuple(m.score(np.nan_to_num(x[:, place], nan=0.0)) for m in models)


def save_demand_models(spark: SparkSession, path: str, models: DemandModels) -> None:
    """Keep the three models and their feature list under one path."""
    save_models(spark, path, {}, {"model_type": "boosted trees", "features": list(models.features)})
    for name in ("point", "low", "high"):
        save_quantile(spark, f"{path}/{name}", getattr(models, name))


def load_demand_models(spark: SparkSession, path: str) -> DemandModels:
    features = load_params(spark, f"{path}/metadata", {})["features"]
    return DemandModels(*(load_quantile(spark, f"{path}/{name}") for name in ("point", "low", "high")), features)


def fit_models(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str = "quantity",
    config: BoostConfig = BoostConfig(), extra_rounds: int = 100, patience: int = 50,
) -> DemandModels:
    """Point model, then both bounds side by side with the point model's best rounds and some more.

    All three share one binning of the rows.
    """
    rows = bin_rows(training_rows(df, features, label))
    point = fit_quantile(rows, 0.5, config, patience)
    bounds = replace(config, rounds=len(point.trees) + extra_rounds)
    fits = [lambda a=a: fit_quantile(rows, a, bounds, patience) for a in (0.1, 0.9)]
    low, high = fit_all(df.sparkSession, fits)
    rows.blocks.unpersist()
    return DemandModels(point, low, high, features)


def point_scorer(model: QuantileBoost, features: Sequence[str] = FEATURES) -> Callable[[DataFrame], DataFrame]:
    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("_x", feature_array(features)).withColumn("pred", model.predict("_x")).drop("_x")

    return score


def mean_error(scored: DataFrame, label: str = "quantity") -> float:
    """MAE of predictions clipped at 0."""
    clipped = F.greatest(F.col("pred"), F.lit(0.0))
    return scored.agg(F.avg(F.abs(F.col(label) - clipped))).first()[0]


def draw_config(rng: random.Random, base: BoostConfig) -> BoostConfig:
    """One random point of the search space."""
    return replace(
        base,
        depth=round(math.log2(rng.uniform(63, 255))),
        step=math.exp(rng.uniform(math.log(0.02), math.log(0.15))),
        column_fraction=rng.uniform(0.6, 1.0),
        row_fraction=rng.uniform(0.6, 1.0),
        min_rows=rng.randint(10, 50),
    )


TUNED = ("depth", "step", "column_fraction", "row_fraction", "min_rows")


def keep_tuned(spark: SparkSession, path: str, best: Mapping[str, object]) -> None:
    """Store the best parameters of a search for later fits."""
    save_params(spark, path, {name: best[name] for name in TUNED})


def tuned_config(spark: SparkSession, path: str, base: BoostConfig = BoostConfig()) -> BoostConfig:
    """``base`` with the parameters kept at ``path``, or as it is where none were kept."""
    return replace(base, **load_params(spark, path, {}))


def random_search(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str = "quantity", trials: int = 50,
    base: BoostConfig = BoostConfig(rounds=500), seed: int = 42,
) -> tuple[DataFrame, dict]:
    """Seeded random search for the lowest validation MAE on the temporal split.

    Trials run one after the other, each a distributed fit. Returns the trial table and
    the best parameters.
    """
    rng, rows = random.Random(seed), []
    held_out = df.where(F.col("split") == "Validation")
    for number in range(trials):
        config = draw_config(rng, base)
        model = fit_point(df, features, label, config)
        error = mean_error(point_scorer(model, features)(held_out), label)
        rows.append((number, config.depth, config.step, config.column_fraction, config.row_fraction,
                     config.min_rows, len(model.trees), error))
    best = min(rows, key=lambda r: r[-1])
    table = df.sparkSession.createDataFrame(
        rows, "trial int, depth int, step double, column_fraction double, row_fraction double, "
        "min_rows int, trees int, val_mae double",
    )
    return table, dict(zip(TUNED, best[1:6], strict=True))


def gain_importance(model: QuantileBoost, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The trees' own gain per feature, as shares."""
    gains = model.gains(len(features)).tolist()
    return df.sparkSession.createDataFrame(list(zip(features, gains, strict=True)), "feature string, importance double")


def permutation_importance(
    model: QuantileBoost, df: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES,
    label: str = "quantity", seed: int = 42,
) -> DataFrame:
    """Rise of the MAE when one feature is taken from another row, over all rows.

    Rows are dealt at random by a hash of their keys; within each Arrow batch one feature after the other is
    permuted and scored. Only sums of errors leave the tasks.
    """
    n = len(features)

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(rows, n).copy()
            y = batch.column(1).to_numpy(zero_copy_only=False)
            order = np.random.default_rng([seed, rows]).permutation(rows)
            out = [np.abs(y - np.maximum(model.score(x), 0)).sum()]
            for i in range(n):
                own = x[:, i].copy()
                x[:, i] = own[order]
                out.append(np.abs(y - np.maximum(model.score(x), 0)).sum())
                x[:, i] = own
            columns = [pa.array(range(-1, n), pa.int32()), pa.array(out), pa.array([rows] * (n + 1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["f", "error", "rows"])

    chance = F.xxhash64(*keys, F.lit(seed))
    dealt = df.where(F.col(label).isNotNull()).select(feature_array(features).alias("x"), F.col(label).cast("double").alias("y"), chance.alias("_chance"), *keys)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "_chance").sortWithinPartitions("_chance", *keys).select("x", "y")
    sums = dealt.mapInArrow(errors, "f int, error double, rows long").groupBy("f").agg((F.sum("error") / F.sum("rows")).alias("mae")).collect()
    mae = {r["f"]: r["mae"] for r in sums}  # a row per feature
    if not mae:
        raise ValueError("permutation importance needs rows")
    return df.sparkSession.createDataFrame([(f, mae[i] - mae[-1]) for i, f in enumerate(features)], "feature string, importance double")
