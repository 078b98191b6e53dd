"""Quantile regression by boosting, which MLlib's tree boosting does not offer.

The pinball loss at 0.5 is half the absolute loss, so the same fit makes the point model and both
bounds. Rows are cut into bins once. A tree grows level by level: each task counts its rows and
those above the fit per node, feature and bin, the counts are shuffled by node and added up, and the
best split of each node follows from them there. Every leaf then takes the quantile of its residuals,
found on the executors alike. Fits
stop by patience on the held-out loss and keep the rounds up to the best one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Hashable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.config import BoostConfig
from tillwise.operators.parallel import totals
from tillwise.staging import scratch_dir, stage

ACCURACY = 10_000
BINS = 64
#: Points in a summary of residuals; a merged summary is off by one part in as many, in ranks.
POINTS = 1024
CUT_EVERY = 20
#: Rows that a task counts at least, if there are more than one.
TASK_ROWS = 20_000
_MODEL_SCHEMA = (
    "tree int, alpha double, step double, start double, feature array<int>, threshold array<double>, "
    "left array<int>, right array<int>, value array<double>, gain array<double>, losses array<double>"
)


@dataclass
class FlatTree:
    """A fitted tree as arrays; a leaf has feature -1 and its own value, a split its gain."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return self.value[at]
            rows = np.flatnonzero(inner)
            node = at[rows]
            goes_left = x[rows, self.feature[node]] <= self.threshold[node]
            at[rows] = np.where(goes_left, self.left[node], self.right[node])


@dataclass
class QuantileBoost:
    """Start value plus step-sized leaf values of every round, up to the best one.

    ``losses`` has the held-out loss of each round that was fitted, also after the best.
    """

    alpha: float
    start: float
    step: float
    trees: list[FlatTree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The predicted quantile for each row of a matrix."""
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += self.step * tree.predict(x)
        return total

    def predict(self, features: str) -> Column:
        """The predicted quantile for an array column of features, in Arrow batches."""
        model = replace(self, losses=[])

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            return pd.Series(model.score(np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, 1))))

        return score(features)

    def gains(self, features: int) -> np.ndarray:
        """Each feature's share of the gain of all splits."""
        total = np.zeros(features)
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return total / max(total.sum(), 1e-300)


def save_quantile(spark: SparkSession, path: str, model: QuantileBoost) -> None:
    """Write the model as a table: one row per tree, plus one for the start value."""
    rows = [(-1, model.alpha, model.step, model.start, *[None] * 6, model.losses)]
    for at, tree in enumerate(model.trees):
        arrays = (tree.feature, tree.threshold, tree.left, tree.right, tree.value, tree.gain)
        rows.append((at, model.alpha, model.step, model.start, *[a.tolist() for a in arrays], None))
    spark.createDataFrame(rows, _MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_quantile(spark: SparkSession, path: str) -> QuantileBoost:
    rows = spark.read.schema(_MODEL_SCHEMA).parquet(path).orderBy("tree").collect()
    names = ("feature", "threshold", "left", "right", "value", "gain")
    trees = [FlatTree(*(np.array(r[c]) for c in names)) for r in rows[1:]]
    return QuantileBoost(rows[0]["alpha"], rows[0]["start"], rows[0]["step"], trees, list(rows[0]["losses"]))


def pinball(residual: Column, alpha: float) -> Column:
    """Quantile loss of one residual (actual minus predicted)."""
    return F.greatest(residual * alpha, residual * (alpha - 1))


@dataclass
class Block:
    """Some rows as arrays: bins (rows x features), label, the held-out mark, a hash, the fit so far."""

    bins: np.ndarray
    label: np.ndarray
    held_out: np.ndarray
    key: np.ndarray
    fit: np.ndarray

    def drawn(self, number: int, share: float) -> np.ndarray:
        """Training rows of one round; a row's draw depends on its content, so a retry repeats it."""
        h = self.key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return np.flatnonzero(~self.held_out & ((h >> np.uint64(40)).astype(float) < share * (1 << 24)))


@dataclass
class BinnedRows:
    """Rows cut into bins once, for any number of fits. ``edges`` are the upper ends of the bins."""

    spark: SparkSession
    blocks: RDD
    edges: list[np.ndarray]
    has_held_out: bool


def bin_rows(rows: DataFrame, bins: int = BINS) -> BinnedRows:
    """Bins of ``features`` (array), with ``label`` and ``held_out``, by quantiles of the training rows.

    A row becomes one byte per feature. Null features and labels are not allowed.
    """
    spark = rows.sparkSession
    rows = stage(rows.select("features", F.col("label").cast("double").alias("label"), "held_out"), "boost-input")
    first = rows.select(F.size("features")).first()
    if first is None:
        raise ValueError("no training rows")
    shares = [k / bins for k in range(1, bins)]
    cuts = [F.percentile_approx(F.get("features", F.lit(i)), shares, ACCURACY).alias(f"c{i}") for i in range(first[0])]
    train = rows.where(~F.col("held_out"))
    found = train.agg(F.count("*").alias("n"), *cuts).first()  # bins - 1 numbers for each feature
    if not found["n"]:
        raise ValueError("no training rows")
    edges = [np.unique(np.array(c, dtype=float)) for c in found[1:]]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            binned = np.stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, x.T, strict=True)], axis=1).astype(np.uint8)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(edges)
            blob = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(binned.tobytes())])
            yield pa.RecordBatch.from_arrays([blob, *batch.columns[1:]], names=["bins", "label", "held_out", "key"])

    keyed = rows.withColumn("key", F.xxhash64(F.col("features").cast("string"), "label"))
    schema = "bins binary, label double, held_out boolean, key long"
    binned = stage(keyed.mapInArrow(cut, schema), "boost-bins")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob = b"".join(batch.column(0).to_pylist())
            parts = [blob, *(batch.column(i).to_numpy(zero_copy_only=False).tobytes() for i in (1, 2, 3))]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["bins", "label", "held_out", "key"])

    width = len(edges)

    def unpack(row: tuple) -> Block:
        label = np.frombuffer(row[1], float)
        return Block(np.frombuffer(row[0], np.uint8).reshape(-1, width), label, np.frombuffer(row[2], bool), np.frombuffer(row[3], np.int64).view(np.uint64), np.zeros(len(label)))

    packed = binned.mapInArrow(pack, "bins binary, label binary, held_out binary, key binary")
    # A few rows for each of many tasks cost more than they count.
    packed = packed.coalesce(max(1, min(packed.rdd.getNumPartitions(), math.ceil(found["n"] / TASK_ROWS))))
    blocks = packed.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    return BinnedRows(spark, blocks, edges, binned.where("held_out").limit(1).count() > 0)


Summary = tuple[np.ndarray, np.ndarray]


def summary(values: np.ndarray, weights: np.ndarray | None = None) -> Summary:
    """Sorted values with weights, at most ``POINTS`` of them; exact while there are no more."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    weights = np.ones(len(values), dtype=np.int64) if weights is None else weights[order]
    if len(values) <= POINTS:
        return values, weights
    upto = np.cumsum(weights)
    ends = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, POINTS + 1) / POINTS))
    ends[-1] = len(values) - 1
    middle = np.searchsorted(upto, (np.append(0, upto[ends[:-1]]) + upto[ends]) / 2)
    return values[middle], np.diff(upto[ends], prepend=0)


def at_share(found: Summary, alpha: float) -> float:
    """The smallest value that a share ``alpha`` of the rows does not exceed."""
    values, weights = found
    upto = np.cumsum(weights)
    return float(values[np.searchsorted(upto, alpha * upto[-1], side="left")])


def best_splits(counts: np.ndarray, alpha: float, min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the best feature, its last bin to the left and the gain (0: no split).

    ``counts`` is nodes x features x bins x (rows, rows above the fit). The gradient is alpha above the
    fit and alpha - 1 below it, so its sums follow from the counts.
    """
    left = counts.cumsum(axis=2)
    whole = left[:, :, -1:, :]
    n, n_all = left[..., 0].astype(float), whole[..., 0].astype(float)
    g, g_all = left[..., 1] - (1 - alpha) * n, whole[..., 1] - (1 - alpha) * n_all
    right = n_all - n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / n + (g_all - g) ** 2 / right - g_all * g_all / n_all
    gain = np.where((n >= min_rows) & (right >= min_rows) & (gain > 1e-9), gain, 0.0)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    return at // gain.shape[2], at % gain.shape[2], flat[np.arange(len(gain)), at]


def grow(blocks: RDD, number: int, alpha: float, config: BoostConfig, edges: list[np.ndarray], found: dict, chosen: np.ndarray) -> FlatTree:
    """One tree, level by level, from the split of its root. Thresholds are bins until the end."""
    tree = FlatTree(*(np.array([v]) for v in (-1, 0.0, -1, -1, 0.0, 0.0)))
    level = np.array([0])
    for depth in range(config.depth):
        if depth:
            found = totals(blocks, counter(number, config, chosen, tree, level), np.add, split_of(alpha, config))
        at = np.array([k for k in range(len(level)) if k in found and found[k][2] > 0], dtype=np.int64)
        if not len(at):
            break
        feature, last, gain = (np.array(v) for v in zip(*(found[k] for k in at.tolist()), strict=True))
        nodes, size = level[at], len(tree.feature)
        tree.feature[nodes], tree.threshold[nodes], tree.gain[nodes] = chosen[feature], last, gain
        tree.left[nodes], tree.right[nodes] = size + 2 * np.arange(len(nodes)), size + 2 * np.arange(len(nodes)) + 1
        more = 2 * len(nodes)
        tree = FlatTree(*(np.append(a, np.full(more, v)) for a, v in zip((tree.feature, tree.threshold, tree.left, tree.right, tree.value, tree.gain), (-1, 0.0, -1, -1, 0.0, 0.0), strict=True)))
        level = np.arange(size, size + more)
    return tree


def split_of(alpha: float, config: BoostConfig) -> Callable[[Hashable, np.ndarray], object]:
    """The best split (feature, last bin, gain) from a node's counts; the held-out loss stays as it is."""
    least = config.min_rows

    def split(key: Hashable, counts: np.ndarray) -> object:
        return counts.tolist() if key == LOSS else tuple(v.item() for v in best_splits(counts[None], alpha, least))

    return split


def counter(number: int, config: BoostConfig, chosen: np.ndarray, tree: FlatTree | None, level: np.ndarray) -> Callable[[Block], dict[int, np.ndarray]]:
    """Counts of a block's drawn rows per chosen feature and bin for each place in the level that has rows."""
    where = np.full(1 if tree is None else len(tree.feature), -1)
    where[level] = np.arange(len(level))
    share = config.row_fraction

    def count(block: Block) -> dict[int, np.ndarray]:
        rows = block.drawn(number, share)
        bins = block.bins[rows]
        node = np.zeros(len(rows), dtype=np.int64) if tree is None else where[places(tree, bins)]
        rows, bins, node = rows[node >= 0], bins[node >= 0], node[node >= 0]
        above = block.label[rows] > block.fit[rows]
        cell = (node[:, None] * len(chosen) + np.arange(len(chosen))) * BINS + bins[:, chosen]
        size = len(level) * len(chosen) * BINS
        both = [np.bincount(c.reshape(-1), minlength=size) for c in (cell, cell[above])]
        counts = np.stack(both, axis=1).reshape(len(level), len(chosen), BINS, 2)
        return {k: counts[k] for k in np.unique(node).tolist()}

    return count


def places(tree: FlatTree, x: np.ndarray) -> np.ndarray:
    """The node each row ends in."""
    return replace(tree, value=np.arange(len(tree.feature))).predict(x)


def fit_quantile(
    rows: DataFrame | BinnedRows, alpha: float, config: BoostConfig = BoostConfig(), patience: int = 50
) -> QuantileBoost:
    """Boost the ``alpha`` quantile of ``label`` on ``features``, without the held-out rows.

    ``patience`` rounds without a lower held-out loss end the fit, and the rounds after
    the best one are dropped; without held-out rows all rounds are fitted. Each round draws a
    share of the rows and of the features. A round takes a job per level and one for the leaves; the driver sees a
    split per node and a value per leaf, however many rows and blocks there are.
    """
    data = rows if isinstance(rows, BinnedRows) else bin_rows(rows)
    sc, edges = data.spark.sparkContext, data.edges
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_dir(data.spark))
    both = lambda a, b: summary(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]))
    quantile = lambda _, found: at_share(found, alpha)
    start = totals(data.blocks, lambda b: {0: summary(b.label[~b.held_out])}, both, quantile)[0]
    model = QuantileBoost(alpha, start, config.step)
    kept: list[RDD] = []
    blocks = moved(data.blocks, kept, lambda b: replace(b, fit=np.full(len(b.label), start)))
    best, best_rounds, per_round = math.inf, 0, max(1, math.ceil(config.column_fraction * len(edges)))
    for number in range(1, config.rounds + 2):
        chosen = np.sort(np.random.default_rng([config.seed, number]).permutation(len(edges))[:per_round])
        root = counter(number + config.seed, config, chosen, None, np.array([0]))
        found = totals(blocks, lambda b, root=root: {**root(b), LOSS: held_out_loss(b, alpha)}, np.add, split_of(alpha, config))
        loss = found.pop(LOSS)
        if data.has_held_out and number > 1:
            model.losses.append(loss[0] / loss[1] / LOSS_SCALE)
            if model.losses[-1] < best:
                best, best_rounds = model.losses[-1], number - 1
            elif number - 1 - best_rounds >= patience:
                break
        if number > config.rounds:
            break
        tree = grow(blocks, number + config.seed, alpha, config, edges, found, chosen)
        for leaf, value in totals(blocks, lambda b, tree=tree: residuals(b, tree), both, quantile).items():
            tree.value[leaf] = value
        step = config.step
        blocks = moved(blocks, kept, lambda b, tree=tree: replace(b, fit=b.fit + step * tree.predict(b.bins)))
        if number % CUT_EVERY == 0:
            blocks.checkpoint()
        tree.threshold = np.array([edges[f][min(int(t), len(edges[f]) - 1)] if f >= 0 else 0.0 for f, t in zip(tree.feature, tree.threshold, strict=True)])
        model.trees.append(tree)
    for old in kept:
        old.unpersist()
    if data.has_held_out:
        del model.trees[best_rounds:]
    return model


#: The key of the held-out loss beside the places of a level.
LOSS, LOSS_SCALE = -1, 1_000_000


def held_out_loss(block: Block, alpha: float) -> np.ndarray:
    """Sum of the held-out rows' loss in millionths, and their number; whole numbers add up alike in any order."""
    left = (block.label - block.fit)[block.held_out]
    return np.array([int(np.rint(np.maximum(left * alpha, left * (alpha - 1)) * LOSS_SCALE).sum()), len(left)], dtype=object)


def residuals(block: Block, tree: FlatTree) -> dict[int, Summary]:
    """Per leaf a summary of what the training rows lie above the fit."""
    rows = np.flatnonzero(~block.held_out)
    if not len(rows):
        return {}
    leaf, left = places(tree, block.bins[rows]), (block.label - block.fit)[rows]
    order = np.argsort(leaf, kind="stable")
    ends = np.flatnonzero(np.diff(leaf[order], append=-1)) + 1
    return {int(leaf[order[e - 1]]): summary(left[order[s:e]]) for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)}


def moved(blocks: RDD, kept: list[RDD], how: Callable[[Block], Block]) -> RDD:
    """The next state of the blocks; only the last two states are held."""
    out = blocks.map(how).persist(StorageLevel.MEMORY_AND_DISK)
    kept.append(out)
    if len(kept) > 2:
        kept.pop(0).unpersist()
    return out
