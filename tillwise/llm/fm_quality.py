"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A score is w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2) through the logistic
function: all pairwise interactions in time linear in the features. Structure statistics are
features of their own, one for each interval of each statistic; metadata is the declared length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import SEPARATORS, encoded, gear_table, held_out, mixed, steps

#: Hashed words, and intervals of each statistic behind them.
WORD_SLOTS, INTERVALS = 1 << 15, 24
STATISTICS = (
    "words", "mean word", "upper", "symbols", "marks", "digits", "bars", "bytes beyond ASCII",
    "distinct words", "distinct lines", "words per line", "declared length",
)
FEATURES = WORD_SLOTS + INTERVALS * len(STATISTICS)
FACTORS = 4
#: Labelled rows the model is fitted on, by the hash of their ids, and passes over them.
TRAIN_ROWS, PASSES, BATCH, STEP, DECAY = 4096, 12, 64, 0.1, 1e-4
THRESHOLD = 0.3


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SPACE, _UPPER, _DIGIT = _class(SEPARATORS), _class(bytes(range(65, 91))), _class(b"0123456789")
_SYMBOL, _MARK, _BAR = _class(b"#*$%&<>{}[]\\^~@=+_"), _class(b"!?"), _class(b"|")
_POWERS = np.cumprod(np.full(1 << 10, 0x9E3779B97F4A7C15, dtype=np.uint64))


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def features(texts: list[bytes], declared: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows' features as (offsets, feature numbers, values); words are weighted by 1 / sqrt(distinct)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.array([len(t) for t in texts])
    bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
    ends = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
    doc = np.searchsorted(bounds, starts, side="right") - 1
    if len(starts):
        # A word's hash: its bytes' random values times powers of a constant, summed.
        length = ends - starts
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        letters = data[np.repeat(starts, length) + place]
        h = np.add.reduceat(gear_table(1)[letters] * _POWERS[place & 1023], np.cumsum(length) - length)
        h = mixed(h)
    else:
        length, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = len(texts)
    words = np.bincount(doc, minlength=n).astype(float)
    # Distinct hashed words of each text.
    slot = np.unique(doc * np.int64(WORD_SLOTS) + (h % np.uint64(WORD_SLOTS)).astype(np.int64))
    slot_doc = slot // WORD_SLOTS
    kinds = np.bincount(np.unique(doc.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20)).astype(np.int64) >> 44, minlength=n).astype(float)
    lines = _sums(data == 10, bounds) + 1
    line_kinds = np.array([len(set(t.split(b"\n"))) for t in texts], dtype=float)
    size = np.maximum(sizes, 1).astype(float)
    said = np.array([0.0 if d is None or d < 0 else float(d) for d in declared])
    at_least = np.maximum(words, 1)
    values = np.stack([
        np.log2(words + 1) / 16, np.minimum(np.bincount(doc, length, minlength=n) / at_least / 16, 1),
        _sums(_UPPER[data], bounds) / size, np.sqrt(_sums(_SYMBOL[data], bounds) / size), np.sqrt(_sums(_MARK[data], bounds) / size),
        np.sqrt(_sums(_DIGIT[data], bounds) / size), np.sqrt(_sums(_BAR[data], bounds) / size), np.sqrt(_sums(data >= 128, bounds) / size),
        kinds / at_least, line_kinds / lines, np.minimum(np.log2(at_least / lines + 1) / 10, 1), np.log2(said + 1) / 20,
    ], axis=1)
    interval = np.clip((values * INTERVALS).astype(np.int64), 0, INTERVALS - 1)
    fixed = WORD_SLOTS + np.arange(len(STATISTICS)) * INTERVALS + interval
    distinct = np.bincount(slot_doc, minlength=n)
    number = np.concatenate([slot % WORD_SLOTS, fixed.reshape(-1)])
    owner = np.concatenate([slot_doc, np.repeat(np.arange(n), len(STATISTICS))])
    weight = np.concatenate([1 / np.sqrt(distinct[slot_doc]), np.full(fixed.size, 1 / np.sqrt(len(STATISTICS)))])
    order = np.argsort(owner, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(distinct + len(STATISTICS))])
    return offsets, number[order], weight[order]


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, offsets: np.ndarray, number: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and each row's factor sums."""
        scaled = self.factors[number] * x[:, None]
        sums = np.add.reduceat(scaled, offsets[:-1], axis=0)
        squares = np.add.reduceat(scaled**2, offsets[:-1], axis=0)
        linear = np.add.reduceat(self.weights[number] * x, offsets[:-1])
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_machine(offsets: np.ndarray, number: np.ndarray, x: np.ndarray, label: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad on small batches in a fixed order of chance."""
    draw = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(FEATURES), draw.normal(0, 0.05, (FEATURES, FACTORS)))
    if not len(label):
        return machine
    share = np.clip(label.mean(), 0.01, 0.99)
    machine.bias = float(np.log(share / (1 - share)))
    past_w, past_v, past_b = np.full(FEATURES, 1e-6), np.full((FEATURES, FACTORS), 1e-6), 1e-6
    for _ in range(PASSES):
        order = draw.permutation(len(label))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            size = offsets[rows + 1] - offsets[rows]
            own = np.repeat(offsets[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
            starts = np.concatenate([[0], np.cumsum(size)])
            k, v = number[own], x[own]
            raw, sums = machine.raw(starts, k, v)
            error = (logistic(raw) - label[rows]) / len(rows)
            each = np.repeat(error, size) * v
            slots, to = np.unique(k, return_inverse=True)
            grad_w = np.bincount(to, each, minlength=len(slots)) + DECAY * machine.weights[slots]
            inner = np.repeat(sums, size, axis=0) - machine.factors[k] * v[:, None]
            grad_v = np.stack([np.bincount(to, each * inner[:, f], minlength=len(slots)) for f in range(FACTORS)], axis=1)
            grad_v += DECAY * machine.factors[slots]
            past_w[slots] += grad_w**2
            past_v[slots] += grad_v**2
            past_b += error.sum() ** 2
            machine.weights[slots] -= STEP * grad_w / np.sqrt(past_w[slots])
            machine.factors[slots] -= STEP * grad_v / np.sqrt(past_v[slots])
            machine.bias -= STEP * error.sum() / np.sqrt(past_b)
    return machine


def _columns(docs: DataFrame) -> DataFrame:
    declared = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "text", declared.alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled documents that are not held out.

    Several labels of a document count as the larger; null labels are left out.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, said = encoded(batch.column(1)), batch.column(2).to_pylist()
            for lo, hi in steps([len(t) for t in texts]):
                offsets, number, x = features(texts[lo:hi], said[lo:hi])
                number, x = np.split(number, offsets[1:-1]), np.split(x, offsets[1:-1])
                columns = [batch.column(0)[lo:hi], batch.column(3)[lo:hi], pa.array(number, pa.list_(pa.int64())), pa.array(x, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "number", "x"])

    joined = _columns(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", "n_chars", F.col("quality").cast("int").alias("quality"))
    sample = joined.mapInArrow(make, "doc_id long, quality int, number array<long>, x array<double>").toArrow().sort_by("doc_id")
    number, x = sample.column("number").combine_chunks(), sample.column("x").combine_chunks()
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in number])])
    flat = lambda a: a.flatten().to_numpy(zero_copy_only=False)
    return fit_machine(offsets, flat(number), flat(x), sample.column("quality").to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for every whole text.

    Null text counts as empty and is scored by its structure; repeated rows are repeated;
    further columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, said = encoded(batch.column(1)), batch.column(2).to_pylist()
            out = [logistic(shared.value.raw(*features(texts[lo:hi], said[lo:hi]))[0]) for lo, hi in steps([len(t) for t in texts])]
            value = np.concatenate(out) if out else np.zeros(0)
            columns = [batch.column(0), batch.column(3), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    rows = _columns(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
