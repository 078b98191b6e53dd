"""Fitted models: recovery of known parameters, invariants and plain recomputations."""

import math
import pickle
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import RDD
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tillwise.config import FEATURES, BoostConfig
from tillwise.operators import boosting, churn, clusters, clv, demand
from tillwise.operators.metrics import temporal_split
from tillwise.plans import reports
from tillwise.staging import scratch_dir


def test_log_gamma():
    x = np.array([1e-3, 0.2, 1.0, 2.5, 17.0, 400.0])
    assert np.allclose(clv.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


def test_hypergeometric_series():
    z = np.array([0.1, 0.5, 0.9])
    assert np.allclose(clv.hyp2f1(np.ones(3), np.ones(3), 2 * np.ones(3), z), -np.log(1 - z) / z)


def test_derivatives_of_log_gamma():
    x, h = np.array([0.05, 0.3, 1.0, 2.5, 17.0, 400.0]), 1e-5
    assert np.allclose(clv.digamma(x), (clv.lgamma(x * (1 + h)) - clv.lgamma(x * (1 - h))) / (2 * h * x), rtol=1e-6, atol=1e-7)
    assert np.allclose(clv.trigamma(x), (clv.digamma(x * (1 + h)) - clv.digamma(x * (1 - h))) / (2 * h * x), rtol=1e-6)
    assert clv.digamma(np.array(1.0)) == pytest.approx(-0.5772156649, abs=1e-9)
    assert clv.trigamma(np.array(1.0)) == pytest.approx(math.pi**2 / 6, abs=1e-9)


@pytest.mark.parametrize("likelihood, at", [(clv.bgnbd_likelihood, [0.8, 6.0, 2.5, 3.0]), (clv.gamma_gamma_likelihood, [6.0, 4.0, 1.3])])
def test_derivatives_of_the_likelihoods(spark, likelihood, at):
    """One pass over the rows against differences of the plain likelihood."""
    rng = np.random.default_rng(5)
    x = rng.integers(0 if len(at) == 4 else 1, 9, 300)
    recent = np.where(x > 0, rng.random(300) * 40, 0.0)
    frame = pd.DataFrame({"frequency": x, "recency": recent, "T": 52.0, "monetary_value": rng.gamma(2, 2, 300), "n": rng.integers(1, 5, 300)})
    value, slope, curve = clv.sum_derivatives(spark.createDataFrame(frame).repartition(3), likelihood, np.log(at))

    def mean(u):
        return np.average(likelihood(np.exp(u), frame), weights=frame.n)

    u, h, axes = np.log(at), 1e-4, np.eye(len(at))
    assert value == pytest.approx(mean(u))
    assert np.allclose(slope, [(mean(u + h * e) - mean(u - h * e)) / (2 * h) for e in axes], atol=1e-6)
    mixed = [[(mean(u + h * (d + e)) - mean(u + h * (d - e)) - mean(u - h * (d - e)) + mean(u - h * (d + e))) / (4 * h * h) for e in axes] for d in axes]
    assert np.allclose(curve, mixed, atol=1e-4)


@pytest.fixture(scope="module")
def buyers(spark):
    """Customers simulated from known purchase, dropout and spend parameters."""
    rng = np.random.default_rng(11)
    r, alpha, a, b, p, q, v, age = 0.8, 6.0, 2.5, 3.0, 6.0, 4.0, 15.0, 52.0
    rows = []
    for customer in range(20_000):
        rate, drop = rng.gamma(r, 1 / alpha), rng.beta(a, b)
        time, count, last = 0.0, 0, 0.0
        while True:
            time += rng.exponential(1 / rate)
            if time > age:
                break
            count, last = count + 1, time
            if rng.random() < drop:
                break
        scale = rng.gamma(q, 1 / v)
        spend = rng.gamma(p * count, 1 / (scale * count)) if count else 0.0
        rows.append((customer, count, last, age, spend))
    frame = pd.DataFrame(rows, columns=["customer_id", "frequency", "recency", "T", "monetary_value"])
    return spark.createDataFrame(frame)


def test_purchase_parameters_are_recovered(buyers):
    got = clv.fit_bgnbd(buyers, penalizer=0.0, fit_on="all")
    assert got["r"] == pytest.approx(0.8, rel=0.15) and got["alpha"] == pytest.approx(6, rel=0.2)
    assert got["a"] / (got["a"] + got["b"]) == pytest.approx(2.5 / 5.5, rel=0.15)
    counts = buyers.groupBy("frequency", "recency", "T").agg(F.count("*").alias("n"))
    best = np.array([got[k] for k in ("r", "alpha", "a", "b")])
    moved = [best * np.where(np.arange(4) == i, f, 1) for i in range(4) for f in (0.8, 1.25)]
    values = clv.sum_likelihoods(counts, clv.bgnbd_likelihood, np.array([best, *moved]))
    assert values[0] >= values[1:].max() - 1e-7


def test_fits_take_few_passes_or_fail(buyers, monkeypatch):
    calls, real = [], clv.sum_derivatives
    monkeypatch.setattr(clv, "sum_derivatives", lambda *a: calls.append(1) or real(*a))
    clv.fit_bgnbd(buyers)
    assert len(calls) <= 12
    calls.clear()
    clv.fit_gamma_gamma(buyers)
    assert len(calls) <= 12
    counts = buyers.groupBy("frequency", "recency", "T").agg(F.count("*").alias("n"))
    with pytest.raises(ArithmeticError, match="passes"):
        clv.maximise(counts, clv.bgnbd_likelihood, np.array([1.0, 50.0, 1.0, 2.0]), 0.01, passes=1)


def test_spend_parameters_are_recovered(buyers):
    got = clv.fit_gamma_gamma(buyers, penalizer=0.0)
    assert got["p"] == pytest.approx(6, rel=0.3) and got["q"] == pytest.approx(4, rel=0.3)
    assert got["p"] * got["v"] / (got["q"] - 1) == pytest.approx(30, rel=0.1)


def test_value_scores(buyers):
    bg, gg = {"r": 0.8, "alpha": 6.0, "a": 2.5, "b": 3.0}, {"p": 6.0, "q": 4.0, "v": 15.0}
    got = clv.score_clv(buyers, bg, gg).toPandas()
    assert len(got) == buyers.where("frequency > 0").count()
    assert (got.clv > 0).all() and (got.clv < got.expected_spend * got.predicted_purchases * 1.01).all()
    zero = clv.expected_purchases(1e-9, np.array([1.0]), np.array([5.0]), np.array([52.0]), bg)
    assert zero[0] == pytest.approx(0, abs=1e-6)


@pytest.fixture(scope="module")
def noisy(spark):
    """Noise whose width depends on the first of two features; the second says nothing."""
    rng = np.random.default_rng(2)
    x = rng.random((4000, 2))
    frame = pd.DataFrame({"x": list(x), "label": 10 + rng.normal(0, 1 + 4 * (x[:, 0] > 0.5))})
    held = (F.pmod(F.xxhash64("features"), F.lit(5)) == 0).alias("held_out")
    rows = spark.createDataFrame(frame).withColumnRenamed("x", "features")
    return rows.select("features", "label", held).repartition(8, "label")


def test_quantile_boost_covers(noisy):
    config = BoostConfig(rounds=6, depth=2, step=0.5, min_rows=20, column_fraction=1.0)
    data = boosting.bin_rows(noisy)  # binned once for both bounds
    low, high = (boosting.fit_quantile(data, a, config, patience=4) for a in (0.1, 0.9))
    scored = noisy.select("label", "features", low.predict("features").alias("lo"), high.predict("features").alias("hi")).toPandas()
    assert ((scored.label >= scored.lo) & (scored.label <= scored.hi)).mean() == pytest.approx(0.8, abs=0.05)
    width = (scored.hi - scored.lo).groupby(scored["features"].map(lambda v: v[0] > 0.5)).mean()
    assert width[True] > 3 * width[False]
    assert high.gains(2)[0] > 0.8 and high.gains(2).sum() == pytest.approx(1)


def plain_boost(x, y, held, keys, alpha, config, edges, rounds):
    """The same rounds on one machine: exhaustive search over all cuts, plain quantiles."""
    def quantile(v):
        v = np.sort(v)
        return v[int(np.searchsorted(np.arange(1, len(v) + 1), alpha * len(v)))]

    fit, losses = np.full(len(y), quantile(y[~held])), []
    for number in range(1, rounds + 1):
        columns = np.sort(np.random.default_rng([config.seed, number]).permutation(x.shape[1])[: math.ceil(config.column_fraction * x.shape[1])])
        block = boosting.Block(x, y, held, keys, fit)
        drawn = np.zeros(len(y), bool)
        drawn[block.drawn(number + config.seed, config.row_fraction)] = True
        gradient = np.where(y > fit, alpha, alpha - 1)
        shift = np.zeros(len(y))

        def split(rows, depth):
            own, best = rows & drawn, (1e-9, None, None)
            for f in columns if depth < config.depth else ():
                for cut in edges[f]:
                    left = own & (x[:, f] <= cut)
                    right = own & ~left
                    if min(left.sum(), right.sum()) >= config.min_rows:
                        gain = sum(gradient[p].sum() ** 2 / p.sum() for p in (left, right)) - gradient[own].sum() ** 2 / own.sum()
                        if gain > best[0] + 1e-9:
                            best = gain, f, cut
            if best[1] is None:
                shift[rows] = quantile((y - fit)[rows & ~held])
                return
            split(rows & (x[:, best[1]] <= best[2]), depth + 1)
            split(rows & (x[:, best[1]] > best[2]), depth + 1)

        split(np.ones(len(y), bool), 0)
        fit = fit + config.step * shift
        left = (y - fit)[held]
        losses.append(np.maximum(left * alpha, left * (alpha - 1)).mean())
    return fit, losses


@pytest.mark.parametrize("alpha", [0.5, 0.9])
def test_rounds_equal_a_plain_loop(noisy, alpha, monkeypatch):
    monkeypatch.setattr(boosting, "POINTS", 100_000)  # exact quantiles
    config = BoostConfig(rounds=4, depth=3, step=0.3, min_rows=30, row_fraction=0.7, column_fraction=0.5)
    data = boosting.bin_rows(noisy, bins=12)
    model = boosting.fit_quantile(data, alpha, config, patience=50)
    table = noisy.withColumn("key", F.xxhash64(F.col("features").cast("string"), "label")).toPandas()
    x = np.stack(table.features)
    inputs = x, table.label.to_numpy(), table.held_out.to_numpy(), table.key.to_numpy().view(np.uint64), alpha, config, data.edges
    assert np.allclose(model.losses, plain_boost(*inputs, 4)[1], atol=1e-6)
    assert np.allclose(model.score(x), plain_boost(*inputs, len(model.trees))[0]) and model.trees


def test_the_driver_gets_splits_and_leaf_values_only(noisy, monkeypatch):
    """What a fit sends to the driver does not grow with its blocks, and the model is that of one block."""
    monkeypatch.setattr(boosting, "POINTS", 100_000)  # exact quantiles
    config = BoostConfig(rounds=3, depth=3, step=0.3, min_rows=30)
    one = boosting.fit_quantile(noisy, 0.5, config)
    monkeypatch.setattr(boosting, "TASK_ROWS", 500)
    data = boosting.bin_rows(noisy)
    assert data.blocks.getNumPartitions() > 4
    sent, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: sent.append(collect(self)) or sent[-1])
    many = boosting.fit_quantile(data, 0.5, config)
    assert sent and max(len(pickle.dumps(got)) for got in sent) < 2_000
    x = np.random.default_rng(4).random((500, 2))
    assert many.losses == one.losses and (many.score(x) == one.score(x)).all()


def test_blocks_without_training_rows(spark):
    """A batch of held-out rows only, as tables sorted by week have it."""
    rows = spark.range(0, 600, 1, 2).select(F.array(F.col("id") % 7.0).alias("features"), (F.col("id") % 7).cast("double").alias("label"), (F.col("id") >= 300).alias("held_out"))
    model = boosting.fit_quantile(rows, 0.5, BoostConfig(rounds=2, depth=2, step=1.0, row_fraction=1.0))
    assert len(model.losses) == 2 and model.trees


def test_patience_ends_the_fit_and_keeps_the_best_round(noisy):
    config = BoostConfig(rounds=200, depth=4, step=0.6, min_rows=5, row_fraction=1.0)
    model = boosting.fit_quantile(noisy, 0.5, config, patience=5)
    best = int(np.argmin(model.losses)) + 1
    assert len(model.trees) == best and len(model.losses) == best + 5 < 200
    # Without held-out rows nothing ends the fit.
    whole = boosting.fit_quantile(noisy.withColumn("held_out", F.lit(False)), 0.5, BoostConfig(rounds=3, depth=2), patience=1)
    assert len(whole.trees) == 3 and whole.losses == []
    with pytest.raises(ValueError, match="no training rows"):
        boosting.fit_quantile(noisy.limit(0), 0.5, config)


def test_fifty_rounds_of_patience(noisy):
    """The default: the 50th round without a lower loss is the last."""
    config = BoostConfig(rounds=1000, depth=1, step=0.9, min_rows=500, row_fraction=1.0)
    model = boosting.fit_quantile(noisy, 0.5, config)
    assert len(model.losses) == len(model.trees) + 50


def test_summaries_keep_ranks():
    rng = np.random.default_rng(3)
    values = rng.gamma(2, 5, 50_000)
    parts = [boosting.summary(p) for p in np.split(values, 10)]
    whole = boosting.summary(*(np.concatenate(c) for c in zip(*parts)))
    assert whole[1].sum() == 50_000 and len(whole[0]) <= boosting.POINTS
    for alpha in (0.1, 0.5, 0.9):
        assert abs((values <= boosting.at_share(whole, alpha)).mean() - alpha) < 2.5 / boosting.POINTS
    assert boosting.at_share(boosting.summary(np.array([3.0, 1.0, 2.0])), 0.5) == 2


@pytest.fixture(scope="module")
def signal(spark):
    """Weeks whose quantity follows one feature; the other is noise."""
    rng = np.random.default_rng(8)
    n = 3000
    frame = pd.DataFrame({"lag_1": rng.integers(0, 50, n).astype(float), "lag_2": rng.random(n), "id": np.arange(n)})
    frame["quantity"] = frame.lag_1 * 2 + rng.normal(0, 1, n)
    frame["week"] = pd.Timestamp("2013-06-03") + pd.to_timedelta(rng.integers(0, 180, n) * 7, unit="D")
    df = spark.createDataFrame(frame).withColumn("week", F.col("week").cast("date"))
    return temporal_split(df)


CONFIG = BoostConfig(rounds=15, depth=4, step=0.4, row_fraction=1.0, column_fraction=1.0)
INPUTS = ["lag_1", "lag_2"]


def test_point_model_beats_the_naive_forecast(signal):
    model = demand.fit_point(signal, INPUTS, config=CONFIG)
    test = signal.where("split = 'Test'")
    naive = test.agg(F.avg(F.abs(F.col("quantity") - F.col("lag_1")))).first()[0]
    assert demand.mean_error(demand.point_scorer(model, INPUTS)(test)) < naive / 4
    moved = demand.permutation_importance(model, test, ["id"], INPUTS).toPandas().set_index("feature").importance
    assert moved["lag_1"] > 10 and abs(moved["lag_2"]) < 1
    gain = demand.gain_importance(model, signal, INPUTS).toPandas().set_index("feature").importance
    assert gain["lag_1"] > 0.9


def test_all_three_models(signal, spark, tmp_path):
    models = demand.fit_models(signal, INPUTS, config=BoostConfig(rounds=4, depth=4, step=0.5, column_fraction=1.0), extra_rounds=2, patience=3)
    test = signal.where("split = 'Test'")
    scored = models.score(test)
    assert {"pred", "pred_lo", "pred_hi"} <= set(scored.columns)
    assert scored.where("pred_hi < pred_lo").count() == 0
    assert max(len(m.losses) for m in (models.low, models.high)) <= len(models.point.trees) + 2
    demand.save_demand_models(spark, str(tmp_path / "models"), models)
    again = demand.load_demand_models(spark, str(tmp_path / "models"))
    columns = ["id", "pred", "pred_lo", "pred_hi"]
    assert again.score(test).select(columns).exceptAll(scored.select(columns)).count() == 0
    x = np.full((5, len(FEATURES)), np.nan)
    x[:, FEATURES.index("lag_1")] = np.arange(5)
    assert np.allclose(again.arrays()(x)[0], models.point.score(np.stack([np.arange(5.0), np.zeros(5)], axis=1)))


def test_scores_need_no_package_on_the_executors():
    """The pickled function runs where the package is not installed."""
    from pyspark import cloudpickle

    code = "import sys, pickle, numpy; f = pickle.loads(bytes.fromhex(sys.stdin.read())); print(round(float(f(numpy.array(5.0))), 6))"
    packed = cloudpickle.dumps(clv.lgamma).hex()
    done = subprocess.run([sys.executable, "-c", code], input=packed, capture_output=True, text=True, cwd="/")
    assert done.stdout.strip() == f"{math.lgamma(5):.6f}", done.stderr


def test_search_returns_its_best_trial(signal, spark, tmp_path):
    table, best = demand.random_search(signal, INPUTS, trials=2, base=BoostConfig(rounds=3))
    rows = table.orderBy("val_mae").collect()
    assert len(rows) == 2 and rows[0].depth == best["depth"] and rows[0].step == best["step"]
    place = str(tmp_path / "tuned")
    assert demand.tuned_config(spark, place, CONFIG) == CONFIG
    demand.keep_tuned(spark, place, best)
    tuned = demand.tuned_config(spark, place, CONFIG)
    assert (tuned.depth, tuned.step, tuned.min_rows, tuned.rounds) == (best["depth"], best["step"], best["min_rows"], CONFIG.rounds)


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(6)
    n = 600
    frame = pd.DataFrame({
        "customer_id": np.arange(n), "recency": rng.integers(1, 300, n), "frequency": rng.integers(1, 20, n),
        "monetary": rng.gamma(2, 100, n), "avg_order_value": rng.gamma(2, 10, n),
    })
    return spark.createDataFrame(frame), frame


def test_standardised_columns(people):
    df, frame = people
    got = churn.standardise(df.withColumn("same", F.lit(3.0)), ["recency", "same"]).toPandas().sort_values("customer_id")
    assert np.allclose(got.recency_std, (frame.recency - frame.recency.mean()) / frame.recency.std(ddof=0))
    assert (got.same_std == 0).all()


def test_out_of_fold_scores_cover_all_customers_once(people):
    df, frame = people
    got = churn.churn_scores(df)
    rows = got.toPandas()
    assert sorted(rows.customer_id) == frame.customer_id.tolist()
    assert rows.churn_risk_score.between(0, 1).all() and rows.churn_risk.notna().all()
    assert churn.ranking_quality(got) > 0.95


def test_folds_share_every_class(people):
    df, _ = people
    labelled = df.withColumn("churned", churn.churn_label(F.col("recency"), 250))
    got = churn.stratified_folds(labelled, "customer_id", "churned", 5).toPandas()
    assert sorted(got.customer_id) == list(range(600)) and set(got._fold) == set(range(5))
    for _, sizes in got.groupby(["churned", "_fold"]).size().groupby("churned"):
        assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1
    again = churn.stratified_folds(labelled.repartition(7), "customer_id", "churned", 5).toPandas()
    assert dict(zip(got.customer_id, got._fold)) == dict(zip(again.customer_id, again._fold))
    twins = labelled.unionByName(labelled.where("customer_id < 50"))
    assert churn.stratified_folds(twins, "customer_id", "churned", 3).count() == 650


def test_churn_quality(people):
    df, _ = people
    got = {r.name: r.value for r in churn.churn_quality(df).collect()}
    assert got["auc_out_of_fold"] > 0.95 and got["weight_recency"] > 1 > abs(got["weight_monetary"])


def test_clusters_and_silhouette(spark):
    rng = np.random.default_rng(7)
    centres = np.array([[0, 0, 0], [30, 0, 5], [0, 30, 9], [30, 30, 14]])
    points = np.vstack([c + rng.normal(0, 1, (60, 3)) for c in centres])
    frame = pd.DataFrame(points, columns=list(clusters.CLUSTER_FEATURES)).assign(customer_id=range(240))
    df = spark.createDataFrame(frame)
    got = clusters.assign_clusters(df, n_init=3).toPandas().sort_values("customer_id")
    names = got.cluster_label.to_numpy().reshape(4, 60)
    assert [set(part) for part in names] == [{"Inactive"}, {"Low value"}, {"Mid value"}, {"High value"}]
    table = clusters.k_diagnostics(df, "customer_id", ks=[2, 4], n_init=2).toPandas().set_index("k")
    assert table.inertia[4] < table.inertia[2] and table.silhouette[4] > 0.8
    assert reports.best_k(clusters.k_diagnostics(df, "customer_id", ks=[2, 4], n_init=2)).first().k == 4


def test_fits_share_their_passes_and_equal_mllib(spark, monkeypatch):
    """Each fit is MLlib's of the same seed, but a pass over the rows serves all of them."""
    points = np.random.default_rng(9).random((900, 3)).tolist()
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id int, x array<double>").repartition(3, "id").select("id", array_to_vector("x").alias("_v"))
    rows.write.parquet(place := f"{scratch_dir(spark)}/shared-passes")
    rows = spark.read.parquet(place)
    calls, real = [], clusters.totals
    monkeypatch.setattr(clusters, "totals", lambda *a: calls.append(1) or real(*a))
    got = clusters.best_fits(rows, [2, 5], 3)
    fits = {k: [KMeans(featuresCol="_v", k=k, seed=42 + i, maxIter=300, tol=1e-4).fit(rows) for i in range(3)] for k in (2, 5)}
    passes = [m.summary.numIter for own in fits.values() for m in own]
    assert len(calls) == max(passes) < sum(passes) / 2
    for k, own in fits.items():
        best = min(own, key=lambda m: m.summary.trainingCost)
        assert got[k].cost == pytest.approx(best.summary.trainingCost, rel=1e-9)
        assert np.allclose(got[k].centres, best.clusterCenters(), atol=1e-9)
        mine = got[k].assign(rows).select("id", "cluster")
        assert mine.exceptAll(best.transform(rows).select("id", F.col("prediction").alias("cluster"))).count() == 0


def test_the_first_of_equal_fits_is_taken(spark):
    """Seeds that find the same clusters differ in the order of the centres and the last digits of the cost."""
    rng = np.random.default_rng(7)
    points = np.vstack([c + rng.normal(0, 1, (70, 2)) for c in ([0, 0], [30, 0], [0, 30], [30, 30])])
    rows = spark.createDataFrame([(p,) for p in points.tolist()], "x array<double>").repartition(4, "x").select(array_to_vector("x").alias("_v"))
    first, many = (clusters.best_fits(rows, [4], n)[4] for n in (1, 6))
    assert np.allclose(first.centres, many.centres, atol=1e-9)


def test_references_do_not_depend_on_the_tasks(spark):
    """The rows that stand for a cluster are the same from one task or seven."""
    points, centres = np.random.default_rng(3).random((300, 2)), np.array([[0.2, 0.2], [0.8, 0.8], [0.2, 0.9]])
    rows = spark.createDataFrame([(i // 2, p) for i, p in enumerate(points.tolist())], "id int, x array<double>").select("id", array_to_vector("x").alias("_v"))
    one, seven = (clusters.silhouettes(rows.repartition(n), "id", [centres, centres[:2]], most=20) for n in (1, 7))
    assert np.allclose(one, seven, atol=1e-9) and min(e for _, e in one) > 0


def test_silhouette_equals_the_definition(spark):
    rng = np.random.default_rng(1)
    points, centres = rng.random((60, 2)), np.array([[0.2, 0.2], [0.8, 0.8], [0.2, 0.9], [5.0, 5.0]])
    points[59] = [4.9, 5.0]  # a cluster of one row
    labels = np.argmin(((points[:, None] - centres[None]) ** 2).sum(2), axis=1)
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    widths = []
    for i, mine in enumerate(labels):
        own = (labels == mine) & (np.arange(60) != i)
        if not own.any():
            widths.append(0.0)
            continue
        near = min(distance[i, labels == k].mean() for k in set(labels) - {mine})
        within = distance[i, own].mean()
        widths.append((near - within) / max(near, within))
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "id int, x array<double>").select("id", array_to_vector("x").alias("_v"))
    (width, error), = clusters.silhouettes(rows, "id", [centres])
    assert width == pytest.approx(np.mean(widths)) and error == 0
    # Ten rows for each cluster: within the error, and all rows count.
    (near, off), = clusters.silhouettes(rows, "id", [centres], most=10)
    assert 0 < off < 0.4 and abs(near - width) <= off
