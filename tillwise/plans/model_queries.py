"""Registered queries around fitted models; SQL cannot repeat these, except the label and
the standardised features."""

from __future__ import annotations

import hashlib
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillwise.config import BoostConfig
from tillwise.operators import churn, clusters, clv, customers, demand, forecast
from tillwise.operators.metrics import regression_metrics, temporal_split
from tillwise.plans import reports
from tillwise.plans.queries import SPLIT, Panel, query
from tillwise.sources import star
from tillwise.staging import scratch_dir, stage

#: Parameters at which the likelihoods are compared with SQL: r, alpha, a, b and p, q, v.
PURCHASE_AT, SPEND_AT = (0.8, 6.5, 0.7, 2.5), (3.5, 4.25, 150000.0)

#: Rounds of the registered fits, with a step to match, and further rounds of the bounds; the rest is as the
#: library has it, 50 rounds of patience too. A round takes a job per tree level, so the default
#: of 1,000 rounds takes many minutes whatever the size of the table (README).
BUDGET, EXTRA_ROUNDS = BoostConfig(rounds=40, step=0.25), 20


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.rfm_base(star.invoices(spark, sf_dir), one_row_per_invoice=True)


def _training(p: Panel) -> DataFrame:
    return stage(temporal_split(p.features, config=SPLIT), "training")


def _models(spark: SparkSession, sf_dir: str, rows: DataFrame) -> demand.DemandModels:
    """The three models of a data folder, fitted once in a session and kept as tables."""
    place = f"{scratch_dir(spark)}/demand-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    try:
        return demand.load_demand_models(spark, place)
    except (AnalysisException, KeyError):  # not there yet
        models = demand.fit_models(rows, config=BUDGET, extra_rounds=EXTRA_ROUNDS)
        demand.save_demand_models(spark, place, models)
        return models


@query
def churn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).select(
        "customer_id", "recency", churn.churn_label(F.col("recency")).alias("churned")
    )


@query
def churn_features_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = churn.standardise(_base(spark, sf_dir), churn.CHURN_FEATURES)
    return scaled.select("customer_id", *[f"{c}_std" for c in churn.CHURN_FEATURES])


@query
def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.churn_scores(_base(spark, sf_dir)).select(
        "customer_id", "recency", "churned", "churn_risk_score", "churn_risk"
    )


@query
def churn_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per fold and class; the shares differ by one customer at most."""
    labelled = _base(spark, sf_dir).select("customer_id", churn.churn_label(F.col("recency")).alias("churned"))
    return churn.stratified_folds(labelled, "customer_id", "churned", 5, into="fold").groupBy("fold", "churned").agg(F.count("*").alias("n"))


@query
def churn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.churn_quality(_base(spark, sf_dir))


@query
def clv_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean log-likelihoods of the purchase and the spend model at fixed parameters."""
    summary = stage(customers.repeat_summary(star.invoices(spark, sf_dir)), "repeat-summary")
    counts = summary.groupBy("frequency", "recency", "T").agg(F.count("*").alias("n"))
    spend = summary.where("frequency > 0 AND monetary_value > 0").groupBy("frequency", "monetary_value").agg(F.count("*").alias("n"))
    bought = clv.sum_likelihoods(counts, clv.bgnbd_likelihood, np.array([PURCHASE_AT]))[0]
    spent = clv.sum_likelihoods(spend, clv.gamma_gamma_likelihood, np.array([SPEND_AT]))[0]
    return spark.createDataFrame([(float(bought), float(spent))], "purchase double, spend double")


@query
def clv_bgnbd(spark: SparkSession, sf_dir: str) -> DataFrame:
    bills = stage(star.invoices(spark, sf_dir), "invoices")
    scored = clv.customer_clv(customers.rfm_base(bills, one_row_per_invoice=True), customers.repeat_summary(bills))
    return scored.select("customer_id", "clv_historical", "clv_projected_12m", "clv_model_type", "predicted_purchases")


@query
def k_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.k_diagnostics(_base(spark, sf_dir), "customer_id")


@query
def best_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = clusters.k_diagnostics(_base(spark, sf_dir), "customer_id")
    return reports.best_k(table)


@query
def customer_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.assign_clusters(_base(spark, sf_dir)).select(
        "customer_id", "recency", "frequency", "monetary", "cluster", "cluster_label"
    )


@query
def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, segment, modelled value, churn risk and cluster of every customer."""
    bills = stage(star.invoices(spark, sf_dir), "invoices")
    people = customers.rfm_segments(customers.rfm_scores(customers.rfm_base(bills, one_row_per_invoice=True)))
    valued = clv.customer_clv(people, customers.repeat_summary(bills))
    risky = churn.churn_scores(stage(valued, "valued"))
    return clusters.assign_clusters(risky).select(
        "customer_id", "recency", "frequency", "monetary", "avg_order_value", "R", "F", "M", "rfm_score",
        "segment", "clv_historical", "clv_projected_12m", "clv_model_type", "churned",
        "churn_risk_score", "churn_risk", "cluster_label",
    )


@query
def demand_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error measures of a fitted point model on the held-out splits."""
    rows = _training(Panel(spark, sf_dir))
    model = demand.fit_point(rows, config=BUDGET)
    return regression_metrics(demand.point_scorer(model)(rows.where("split <> 'Train'")))


@query
def demand_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error measures and interval coverage of the three fitted models."""
    rows = _training(Panel(spark, sf_dir))
    return regression_metrics(_models(spark, sf_dir, rows).score(rows.where("split <> 'Train'")))


@query
def model_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursive forecast with the fitted models."""
    p = Panel(spark, sf_dir)
    rows = _training(p)
    return forecast.forecast(rows, p.days, p.calendar, _models(spark, sf_dir, rows))


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permutation importance on held-out rows next to the trees' gain."""
    rows = _training(Panel(spark, sf_dir))
    model = _models(spark, sf_dir, rows).point
    held_out = rows.where("split = 'Test'")
    moved = demand.permutation_importance(model, held_out, ["product_id", "store_id", "week"])
    gain = demand.gain_importance(model, rows).withColumnRenamed("importance", "gain")
    return moved.join(F.broadcast(gain), "feature")  # a row per feature


@query
def model_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training(Panel(spark, sf_dir))
    model = _models(spark, sf_dir, rows).point
    metrics = regression_metrics(demand.point_scorer(model)(rows.where("split <> 'Train'")))
    told = {"best_round": len(model.trees), "fitted_rounds": len(model.losses), "validation_mae": 2 * min(model.losses)}
    return reports.model_card(stage(metrics, "metrics"), demand.gain_importance(model, rows), training=told)


@query
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training(Panel(spark, sf_dir))
    table, _ = demand.random_search(rows, trials=3, base=replace(BUDGET, rounds=6))
    return table
