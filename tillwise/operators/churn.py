"""Churn label, standardised features and out-of-fold risk."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.columns import churn_tier, flag
from tillwise.operators.parallel import fit_all
from tillwise.operators.ranks import running_total
from tillwise.staging import stage

CHURN_FEATURES = ("recency", "frequency", "monetary", "avg_order_value")


def churn_label(recency: Column, days: int = 90) -> Column:
    """1 when the customer has not bought for more than ``days``.

    Recency is a model feature too, so the model's AUC is high by construction.
    """
    return flag(recency > days)


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column with mean 0 and population deviation 1, null as 0 before; a constant
    column becomes 0. The driver sees two numbers per column."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    stats = df.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"s_{c}") for c, v in filled.items()],
    ).first()
    return df.withColumns({
        f"{c}_std": (v - (stats[f"m_{c}"] or 0.0)) / (stats[f"s_{c}"] or 1.0) for c, v in filled.items()
    })


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 42, into: str = "_fold") -> DataFrame:
    """Folds 0..k-1 in which every class has the same number of rows, give or take one.

    Rows are ranked by class and, within it, by the hash of their key; the rank modulo k is the
    fold. The ranking is one range shuffle, so neither a class nor a fold meets in a task. A row's
    place among equal keys does not matter.
    """
    chance = df.withColumn("_chance", F.xxhash64(key, F.lit(seed))).withColumn("_twin", F.monotonically_increasing_id())
    ranked = running_total(stage(chance, "fold-keys"), [label, "_chance", key, "_twin"], None, "_rank")
    return ranked.withColumn(into, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank", "_chance", "_twin")


def fit_churn(rows: DataFrame, label: str = "churned", c: float = 1.0) -> LogisticRegressionModel:
    """Ridge-penalised logistic regression of strength 1 / C on ``_features``."""
    return LogisticRegression(
        featuresCol="_features", labelCol=label, maxIter=500, elasticNetParam=0.0,
        regParam=1.0 / (c * max(rows.count(), 1)), standardization=False,
        probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class",
    ).fit(rows.select("_features", label))


def feature_vector(features: Sequence[str] = CHURN_FEATURES) -> Column:
    return array_to_vector(F.array(*[F.col(f"{f}_std") for f in features]))


def oof_probability(
    df: DataFrame, key: str, features: Sequence[str] = CHURN_FEATURES, label: str = "churned",
    k: int = 5, c: float = 1.0, into: str = "churn_risk_score",
) -> DataFrame:
    """Probability of the label for every row, from a model that has not seen its fold.

    The features are standardised over all rows and the folds stratified by the label. The
    folds are independent fits on the cluster; no row is scored twice.
    """
    ready = standardise(df, features).withColumn("_features", feature_vector(features)).drop(*[f"{f}_std" for f in features])
    rows = stage(stratified_folds(ready, key, label, k), "folds")
    folds = range(k)
    models = fit_all(rows.sparkSession, [partial(fit_churn, rows.where(F.col("_fold") != fold), label, c) for fold in folds])
    risk = F.bround(F.get(vector_to_array("_probability"), F.lit(1)), 3)
    parts = [
        model.transform(rows.where(F.col("_fold") == fold)).withColumn(into, risk)
        for fold, model in zip(folds, models)
    ]
    return reduce(DataFrame.unionByName, parts).drop("_features", "_fold", "_probability", "_raw", "_class")


def churn_quality(base: DataFrame, key: str = "customer_id", days: int = 90, features: Sequence[str] = CHURN_FEATURES) -> DataFrame:
    """Name and value: the AUC of the out-of-fold scores, then intercept and weights (per standard
    deviation) of the final model, fitted on all rows."""
    scored = stage(churn_scores(base, key, days), "churn-scored")
    ready = standardise(scored.drop("churn_risk_score", "churn_risk"), features).withColumn("_features", feature_vector(features))
    final = fit_churn(stage(ready.select("_features", "churned"), "churn-final"))
    weights = zip(features, final.coefficients.toArray().tolist(), strict=True)
    rows = [("auc_out_of_fold", ranking_quality(scored)), ("intercept", float(final.intercept)), *[(f"weight_{f}", w) for f, w in weights]]
    return base.sparkSession.createDataFrame(rows, "name string, value double")


def churn_scores(base: DataFrame, key: str = "customer_id", days: int = 90) -> DataFrame:
    """Label, out-of-fold risk and risk tier per customer."""
    labelled = base.withColumn("churned", churn_label(F.col("recency"), days))
    scored = oof_probability(labelled, key)
    return scored.withColumn("churn_risk", churn_tier(F.col("churn_risk_score")))


def ranking_quality(scored: DataFrame, score: str = "churn_risk_score", label: str = "churned") -> float:
    """Area under the ROC curve."""
    rows = scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("l"))
    return BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="l").evaluate(rows)
