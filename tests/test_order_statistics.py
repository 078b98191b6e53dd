"""Distributed ranks, quantiles and medians against plain computations, skewed input included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.operators import joins, ranks
from tillwise.operators.sampling import bounded_sample


@pytest.fixture(scope="module")
def skewed(spark):
    """Ids with a value; a third of the rows share one value and one group."""
    rng = np.random.default_rng(3)
    n = 3000
    frame = pd.DataFrame({"id": np.arange(n), "v": rng.integers(0, 400, n), "g": rng.integers(0, 40, n)})
    frame.loc[: n // 3, ["v", "g"]] = [7, 1]
    frame["x"] = np.where(frame.g == 1, rng.integers(0, 900, n), rng.integers(0, 20, n)).astype(float)
    return spark.createDataFrame(frame), frame


def test_running_total_is_a_unique_rank(skewed):
    df, frame = skewed
    got = ranks.running_total(df, ["v", "id"]).toPandas().sort_values("id")
    want = frame.sort_values(["v", "id"]).reset_index(drop=True)
    want["rank"] = want.index + 1
    assert (got.running.to_numpy() == want.sort_values("id")["rank"].to_numpy()).all()


def test_ranges_share_a_hot_value(spark, skewed, monkeypatch):
    """Equal leading values are split over the ranges by the tie key."""
    df, _ = skewed
    parts = df.repartitionByRange(8, "v", "id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 3 * 3000 / 8


def test_exact_quantiles(skewed):
    df, frame = skewed
    probabilities = [0, 0.2, 0.37, 0.5, 0.97, 1]
    got = ranks.exact_quantiles(df, "x", probabilities)
    assert np.allclose(got, np.quantile(frame.x, probabilities))


def test_exact_quantiles_without_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert ranks.exact_quantiles(empty, "x", [0.5]) == [None]


def test_grouped_median(skewed):
    df, frame = skewed
    got = ranks.grouped_median(df, ["g"], "x").toPandas().set_index("g")["median"]
    want = frame.groupby("g").x.median()
    assert np.allclose(got.sort_index(), want)


def test_quintiles_match_quantile_cut(spark):
    for n in (5, 7, 23, 100):
        frame = pd.DataFrame({"id": range(n), "v": [(i * 37) % 11 for i in range(n)]})
        want = pd.qcut(frame.v.rank(method="first"), 5, labels=False) + 1
        got = ranks.quintile_by_rank(spark.createDataFrame(frame), "v", "id", "q").toPandas().sort_values("id")
        assert got.q.tolist() == want.tolist(), n


def test_seven_ranks(spark):
    frame = spark.range(7).withColumn("v", F.col("id"))
    got = [r.q for r in ranks.quintile_by_rank(frame, "v", "id", "q").orderBy("id").collect()]
    assert got == [1, 1, 2, 3, 4, 5, 5]


def test_value_edges_reversed(spark):
    values = [7, 60, 61, 129, 225, 226, 300, 396, 500, 1787]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = ranks.quintile_by_edges(df, "v", "q", reverse=True).toPandas().sort_values("v").q
    assert got.tolist() == pd.qcut(pd.Series(values), 5, labels=[5, 4, 3, 2, 1]).astype(int).tolist()


def test_equal_edges(spark):
    df = spark.createDataFrame([(1,)] * 8 + [(2,), (3,)], "v int")
    with pytest.raises(ValueError, match="not unique"):
        ranks.quintile_by_edges(df, "v", "q")
    kept = ranks.quintile_by_edges(df, "v", "q", duplicates="drop").toPandas()
    assert set(kept.q) == {1, 2}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_hot_keys_join_like_any_other(skewed, spark, how):
    df, _ = skewed
    dim = spark.createDataFrame([(k, f"name {k}") for k in range(0, 40, 2)] + [(1, "hot")], "g long, name string")
    fact = df.unionByName(df.limit(5).withColumn("g", F.lit(None).cast("long")))
    split = joins.dim_join(fact, dim, "g", how, broadcast_bytes=0)
    plain = fact.join(dim, "g", how)
    assert split.count() == plain.count()
    assert split.exceptAll(plain.select(split.columns)).count() == 0


def test_size_estimate_decides(spark, sf_dir):
    small = spark.read.parquet(f"{sf_dir}/nation.parquet")
    assert 0 < joins.plan_bytes(small) < joins.BROADCAST_BYTES


def test_sample_ignores_partitioning(skewed):
    df, _ = skewed
    one = bounded_sample(df.repartition(3), ["id"], 50).toPandas().id
    two = bounded_sample(df.repartition(11, "v"), ["id"], 50).toPandas().id
    assert sorted(one) == sorted(two) and len(one) == 50


def test_null_groups_have_a_median(spark):
    df = spark.createDataFrame([(None, None, 1.0), (None, None, 3.0), (1, 1, 5.0), (1, None, 7.0)], "a int, b int, v double")
    got = {(r.a, r.b): r["median"] for r in ranks.grouped_median(df, ["a", "b"], "v").collect()}
    assert got == {(None, None): 2.0, (1, 1): 5.0, (1, None): 7.0}
