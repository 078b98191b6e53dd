"""Customer clusters and the diagnostics to choose their number."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.config import CLUSTER_LABELS
from tillwise.operators.churn import standardise
from tillwise.operators.parallel import fit_all, totals
from tillwise.staging import stage

CLUSTER_FEATURES = ("recency", "frequency", "monetary")
#: Rows that stand for a cluster in the silhouette; a smaller cluster is there as a whole.
REFERENCES = 512
#: Costs that lie no further apart, as a share, are equal.
SAME_COST = 1e-9
#: Rows whose distances are worked out at once.
CHUNK = 2048


def scaled_vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with their standardised features as a vector ``_v``, staged for many fits."""
    array = F.array(*[F.col(f"{f}_std") for f in features])
    scaled = standardise(df, features).withColumn("_v", array_to_vector(array))
    return stage(scaled.drop(*[f"{f}_std" for f in features]), "scaled")


@dataclass(frozen=True)
class Clustering:
    """Centres of a fit, and the squared distances to the centres of its last pass, summed over all rows."""

    centres: np.ndarray
    cost: float

    def assign(self, rows: DataFrame) -> DataFrame:
        """Add the nearest centre of ``_v`` as ``cluster``, the first of equal ones."""
        at = vector_to_array("_v")
        x = [F.get(at, F.lit(i)) for i in range(self.centres.shape[1])]
        far = F.array(*[reduce(add, [(v - F.lit(float(c))) ** 2 for v, c in zip(x, centre, strict=True)]) for centre in self.centres])
        return rows.withColumn("_far", far).withColumn("cluster", (F.array_position("_far", F.array_min("_far")) - 1).cast("int")).drop("_far")


def best_fits(rows: DataFrame, ks: Sequence[int], n_init: int, seed: int = 42, passes: int = 300, tol: float = 1e-4) -> dict[int, Clustering]:
    """For each k, the fit of lowest cost among ``n_init`` seeds, the first of equal ones.

    Each fit starts from MLlib's k-means|| centres. All fits then move on side by side: a pass over the rows
    moves the centres of every fit, and a fit leaves when no centre of its moves by over ``tol``.
    """
    wanted = [(k, seed + i) for k in ks for i in range(n_init)]

    def start(k: int, seed: int) -> np.ndarray:
        model = KMeans(featuresCol="_v", predictionCol="cluster", k=k, seed=seed, maxIter=0).fit(rows)
        return np.array(model.clusterCenters())

    centres = fit_all(rows.sparkSession, [partial(start, k, s) for k, s in wanted])
    blocks, cost, moving = packed(rows), [0.0] * len(wanted), list(range(len(wanted)))
    for _ in range(passes):
        if not moving:
            break
        sums = totals(blocks, mover({f: centres[f] for f in moving}), np.add, lambda _, found: found)
        for f in moving.copy():
            old, found = centres[f], sums[f]
            filled = found[:, -2] > 0  # an empty cluster keeps its centre
            centres[f] = np.where(filled[:, None], found[:, :-2] / np.where(filled, found[:, -2], 1)[:, None], old)
            cost[f] = float(found[:, -1].sum())
            if (((centres[f] - old) ** 2).sum(axis=1) <= tol * tol).all():
                moving.remove(f)
    blocks.unpersist()
    # Fits that end in the same centres differ in their last digits only: the first of them is taken.
    tried = {k: [at for at, (kk, _) in enumerate(wanted) if kk == k] for k in ks}
    best = {k: next(at for at in own if not cost[at] > min(cost[i] for i in own) * (1 + SAME_COST)) for k, own in tried.items()}
    return {k: Clustering(centres[at], cost[at]) for k, at in best.items()}


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    """Arrays of one length as a matrix with a row each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def packed(rows: DataFrame) -> RDD:
    """The vectors of ``rows`` as matrices, kept for many passes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.ascontiguousarray(matrix(batch.column(0), batch.num_rows))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([x.shape[1]], pa.int32())], names=["x", "width"])

    vectors = rows.select(vector_to_array("_v").alias("x"))
    blocks = vectors.mapInArrow(pack, "x binary, width int").rdd.map(lambda r: np.frombuffer(r[0], float).reshape(-1, r[1]))
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def mover(centres: dict[int, np.ndarray]) -> Callable[[np.ndarray], dict[int, np.ndarray]]:
    """For some rows, per fit and centre: the sums of its rows, their number and their squared distances."""
    every = np.concatenate(list(centres.values()))
    weights = np.hstack([-2 * every, (every**2).sum(axis=1)[:, None]])

    def move(x: np.ndarray) -> dict[int, np.ndarray]:
        out = {f: np.zeros((len(c), x.shape[1] + 2)) for f, c in centres.items()}
        for lo in range(0, len(x), CHUNK):
            part = np.ascontiguousarray(x[lo : lo + CHUNK].T)
            own = (part**2).sum(axis=0)
            far = weights @ np.vstack([part, np.ones(part.shape[1])])  # squared distances less those to 0
            first = 0
            for f, c in centres.items():
                best, label = far[first], np.zeros(part.shape[1], dtype=np.int64)
                for i in range(1, len(c)):
                    closer = far[first + i] < best
                    np.copyto(label, i, where=closer)
                    best = np.minimum(best, far[first + i])
                first += len(c)
                for i, v in enumerate((*part, None, np.maximum(own + best, 0))):
                    out[f][:, i] += np.bincount(label, v, len(c))
        return out

    return move


def labels_of(x: np.ndarray, centres: Sequence[np.ndarray]) -> np.ndarray:
    """Nearest centre of each row under each clustering (rows x clusterings)."""
    return np.stack([((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).argmin(axis=1) for c in centres], axis=1)


def silhouettes(rows: DataFrame, key: str, centres: Sequence[np.ndarray], most: int = REFERENCES, seed: int = 42) -> list[tuple[float, float]]:
    """Mean Euclidean silhouette of all rows under each clustering, and how far it may be off.

    Each cluster is stood for by the ``most`` of its rows whose keys hash lowest; only these are sent to
    the tasks. A cluster of no more rows is there as a whole, so its mean distances are exact. The error is
    two standard errors of the mean distances, as a share of the larger one, on average; 0 if all
    clusters are whole. A cluster of one row counts 0.
    """
    spark = rows.sparkSession
    points = rows.select(vector_to_array("_v").alias("x"), F.xxhash64(key, F.lit(seed)).alias("chance"))
    fixed = spark.sparkContext.broadcast(list(centres))

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: Counter = Counter()
        lowest: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            x, chance = matrix(batch.column(0), batch.num_rows), batch.column(1).to_numpy(zero_copy_only=False)
            tags = labels_of(x, fixed.value)
            for c in range(tags.shape[1]):
                for k in np.unique(tags[:, c]).tolist():
                    own = tags[:, c] == k
                    sizes[c, k] += int(own.sum())
                    near = (x[own], chance[own])
                    if (c, k) in lowest:
                        near = tuple(np.concatenate(both) for both in zip(lowest[c, k], near, strict=True))
                    at = np.lexsort((*near[0].T[::-1], near[1]))[:most]
                    lowest[c, k] = near[0][at], near[1][at]
        for (c, k), (x, chance) in lowest.items():
            n = len(x)
            columns = [np.full(n, c), np.full(n, k), np.append(sizes[c, k], np.zeros(n - 1, dtype=np.int64)), x.tolist(), chance]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["c", "cluster", "size", "x", "chance"])

    # Each task gives its ``most`` rows per cluster, the first with the number of its rows in the cluster.
    every = points.mapInArrow(tagged, "c long, cluster long, size long, x array<double>, chance long")
    own = W.partitionBy("c", "cluster")
    placed = every.withColumns({"place": F.row_number().over(own.orderBy("chance", "x")), "size": F.sum("size").over(own)})
    sizes: dict[tuple[int, int], int] = {}
    drawn: dict[tuple[int, int], list] = {}
    for r in placed.where(F.col("place") <= most).collect():  # ``most`` rows per cluster
        sizes[r["c"], r["cluster"]] = r["size"]
        drawn.setdefault((r["c"], r["cluster"]), []).append((r["chance"], r["x"]))
    known = spark.sparkContext.broadcast({at: (np.array([x for _, x in own]), max(h for h, _ in own), sizes[at]) for at, own in drawn.items()})

    def widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(fixed.value)
        width, error, count = np.zeros(n), np.zeros(n), 0
        for batch in batches:
            x = matrix(batch.column(0), batch.num_rows)
            chance = batch.column(1).to_numpy(zero_copy_only=False)
            count += len(x)
            for lo in range(0, len(x), 500):
                part, own_chance = x[lo : lo + 500], chance[lo : lo + 500]
                tags = labels_of(part, fixed.value)
                for c in range(n):
                    w, e = widths_of(part, own_chance, tags[:, c], {k: v for (i, k), v in known.value.items() if i == c})
                    width[c], error[c] = width[c] + w.sum(), error[c] + e.sum()
        columns = [pa.array(range(n), pa.int64()), pa.array(width), pa.array(error), pa.array([count] * n, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["c", "width", "error", "n"])

    sums = points.mapInArrow(widths, "c long, width double, error double, n long").groupBy("c").agg(F.sum("width"), F.sum("error"), F.sum("n"))
    found = {c: (w / n, e / n) if n else (0.0, 0.0) for c, w, e, n in sums.collect()}  # a row per clustering
    fixed.unpersist(), known.unpersist()
    return [found.get(c, (0.0, 0.0)) for c in range(len(centres))]


def widths_of(x: np.ndarray, chance: np.ndarray, tag: np.ndarray, known: dict[int, tuple[np.ndarray, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Silhouette of some rows under one clustering, and twice the standard error of each."""
    within, near = np.zeros(len(x)), np.full(len(x), np.inf)
    off_within, off_near = np.zeros(len(x)), np.zeros(len(x))
    alone = np.zeros(len(x), dtype=bool)
    for cluster, (points, last, size) in known.items():
        # Squared distances by one product, about the rows' own centre to keep their digits.
        m, mine, middle = len(points), tag == cluster, points.mean(axis=0)
        a, b = x - middle, points - middle
        a_square, b_square = (a**2).sum(axis=1), (b**2).sum(axis=1)
        square = np.hstack([a, a_square[:, None], np.ones((len(a), 1))]) @ np.hstack([-2 * b, np.ones((m, 1)), b_square[:, None]]).T
        distance = np.sqrt(np.maximum(square, 0, out=square), out=square)
        total = distance.sum(axis=1)
        mean = total / m
        squares = a_square + b_square.mean()  # the points' mean is 0 here
        spread = np.sqrt(np.maximum(squares - mean**2, 0)) * np.sqrt(max(0.0, 1 - m / size) / m)
        closer = ~mine & (mean < near)
        near[closer], off_near[closer] = mean[closer], spread[closer]
        # A row that stands for its own cluster is not a neighbour of itself.
        others = np.maximum(m - (mine & (chance <= last)), 1)
        within[mine], off_within[mine] = (total / others)[mine], spread[mine]
        alone |= mine & (size < 2)
    larger = np.maximum(np.maximum(within, np.where(np.isinf(near), within, near)), 1e-300)
    width = np.where(np.isinf(near) | alone, 0.0, (np.where(np.isinf(near), 0.0, near) - within) / larger)
    return width, 2 * (off_within + off_near) / larger


def k_diagnostics(
    df: DataFrame, key: str, features: Sequence[str] = CLUSTER_FEATURES, ks: Sequence[int] = range(2, 9),
    n_init: int = 10, most: int = REFERENCES,
) -> DataFrame:
    """Inertia and silhouette of all rows for each number of clusters.

    ``silhouette`` is Euclidean, off by ``silhouette_error`` at most in all likelihood (0: exact);
    ``silhouette_squared`` is Spark's squared-Euclidean measure.
    """
    rows = scaled_vectors(df, features)
    models = best_fits(rows, list(ks), n_init)
    evaluator = ClusteringEvaluator(featuresCol="_v", predictionCol="cluster")
    squared = fit_all(rows.sparkSession, [partial(evaluator.evaluate, m.assign(rows)) for m in models.values()])
    widths = silhouettes(rows, key, [m.centres for m in models.values()], most)
    table = [
        (k, m.cost, round(w, 4), round(e, 4), round(s, 4))
        for (k, m), (w, e), s in zip(models.items(), widths, squared)
    ]
    return df.sparkSession.createDataFrame(
        table, "k int, inertia double, silhouette double, silhouette_error double, silhouette_squared double"
    )


def cluster_labels(assigned: DataFrame, label_by: str, labels: Sequence[str] = CLUSTER_LABELS) -> DataFrame:
    """Name the clusters by falling mean of a column; clusters beyond the names get none."""
    means = assigned.groupBy("cluster").agg(F.avg(label_by).alias("_mean"))
    place = F.rank().over(W.orderBy(F.desc("_mean"))) - 1  # a row per cluster
    names = F.array(*[F.lit(name) for name in labels])
    named = means.select("cluster", F.get(names, place).alias("cluster_label"))
    return assigned.join(F.broadcast(named), "cluster", "left")


def assign_clusters(
    df: DataFrame, features: Sequence[str] = CLUSTER_FEATURES, k: int = 4, label_by: str = "monetary", n_init: int = 10
) -> DataFrame:
    """Each row's cluster and the cluster's value label."""
    rows = scaled_vectors(df, features)
    assigned = best_fits(rows, [k], n_init)[k].assign(rows).drop("_v")
    return cluster_labels(assigned, label_by)
