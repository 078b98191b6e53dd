"""Language identification by prediction by partial matching.

Each language has byte contexts of up to three bytes with frozen counts. A byte not seen after
a context escapes to the next shorter one (the number of different successors counts as the
escape), the bytes already excluded there, so the probabilities of all 256 bytes add up to
one and minus the sum of their logarithms is the exact code length. The shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import encoded, held_out, released, steps, tidy

ORDER = 3
#: Labelled texts that each language's statistics are taken from, by the hash of their ids.
TRAIN_ROWS = 2000
#: Contexts with fewer bytes than this in all languages together are left out of the trees.
LEAST_COUNT = 24
UNKNOWN = "und"
#: Contexts worked out together.
CONTEXTS = 1024
#: A text may take so many times the bits per byte that are usual in its language. On the largest table at
#: hand clean texts take 1.5 times as many at most, capitals and long numbers 3, random letters 6.
MOST_TIMES = 4.0
#: Texts looked at together.
ROWS = 512
#: What stands before the first byte of a text.
PAD = b"\n" * ORDER


@dataclass
class Model:
    """``step[state, class]`` is the next context; ``bits[state, class, language]`` a code length."""

    languages: list[str]
    byte_class: np.ndarray
    step: np.ndarray
    bits: np.ndarray

    def shared(self, spark: SparkSession) -> Broadcast:
        """The model as the tasks read it, sent out once."""
        if "sent" not in self.__dict__:
            self.__dict__["sent"] = spark.sparkContext.broadcast((self.languages, self.byte_class, self.step, self.bits))
        return self.__dict__["sent"]


def grams(docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Counts of (language, three bytes of context and the next byte) over the training rows."""
    labelled = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("chance"))
    # First in 64 parts of each language, so that no language meets in one task.
    for part in (F.pmod("chance", F.lit(64)), F.lit(0).cast("long")):
        by = Window.partitionBy("lang", "part").orderBy("chance", "doc_id")
        chosen = chosen.withColumn("part", part).withColumn("n", F.row_number().over(by)).filter(F.col("n") <= rows)
    chosen = chosen.select("doc_id").distinct()  # ``rows`` ids for each language at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = encoded(batch.column(0)), np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                data = np.frombuffer(b"".join(PAD + texts[i] for i in np.flatnonzero(langs == lang)) + PAD, np.uint8).astype(np.uint32)
                gram = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
                values, n = np.unique(gram, return_counts=True)
                columns = [pa.array([lang] * len(values)), pa.array(values.astype(np.int64)), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    texts = labelled.join(F.broadcast(chosen), "doc_id", "left_semi").select("text", "lang")
    return texts.mapInArrow(tidy(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, least: int = LEAST_COUNT) -> Model:
    """Frozen trees of all languages. The driver gets counts of distinct four-byte strings only."""
    found = grams(docs, rows).toPandas().sort_values(["lang", "gram"])
    languages = sorted(found["lang"].unique())
    gram = found["gram"].to_numpy(dtype=np.int64)
    counts = found["n"].to_numpy(dtype=np.float64)
    lang = np.searchsorted(languages, found["lang"].to_numpy()) if languages else np.zeros(0, np.int64)
    used = np.unique(gram & 255)
    byte_class = np.full(256, len(used), dtype=np.int64)
    byte_class[used] = np.arange(len(used))
    classes = len(used) + 1  # the last class is any byte never seen
    unseen = max(256 - len(used), 1)

    # Contexts by order, each closed under taking away its first or last byte.
    kept: list[np.ndarray] = [np.zeros(1, dtype=np.int64)]
    for order in range(1, ORDER + 1):
        context = (gram >> 8) & ((1 << 8 * order) - 1)
        values, at = np.unique(context, return_inverse=True)
        total = np.bincount(at, counts, minlength=len(values))
        fine = (total >= least) & np.isin(values & ((1 << 8 * (order - 1)) - 1), kept[-1]) & np.isin(values >> 8, kept[-1])
        kept.append(values[fine])
    first = np.cumsum([0] + [len(k) for k in kept])
    states = int(first[-1])

    bits = np.zeros((states, classes, max(len(languages), 1)), dtype=np.float32)
    base = np.full(classes, 1 / 256)
    base[-1] = unseen / 256
    shorter = np.repeat(base[None, :, None], max(len(languages), 1), axis=2)  # order -1: every byte alike
    for order, contexts in enumerate(kept):
        context = (gram >> 8) & ((1 << 8 * order) - 1)
        at = np.searchsorted(contexts, context)
        there = np.flatnonzero((at < len(contexts)) & (contexts[np.minimum(at, len(contexts) - 1)] == context)) if len(contexts) else np.zeros(0, np.int64)
        there = there[np.argsort(at[there], kind="stable")]
        parent = np.zeros(len(contexts), dtype=np.int64) if order <= 1 else np.searchsorted(kept[order - 1], contexts & ((1 << 8 * (order - 1)) - 1))
        longer = []
        for lo in range(0, len(contexts), CONTEXTS):  # some contexts at a time bound the driver's memory
            hi = min(lo + CONTEXTS, len(contexts))
            own = there[np.searchsorted(at[there], lo) : np.searchsorted(at[there], hi)]
            n = np.zeros((hi - lo, classes, max(len(languages), 1)))
            np.add.at(n, (at[own] - lo, byte_class[gram[own] & 255], lang[own]), counts[own])
            below = shorter[parent[lo:hi]]
            seen = n > 0
            kinds = seen.sum(axis=1, keepdims=True)
            total = n.sum(axis=1, keepdims=True) + kinds
            rest = np.where(seen, 0, below).sum(axis=1, keepdims=True)
            escape = np.where(kinds > 0, kinds / np.maximum(total, 1), 1.0)
            p = np.where(seen, n / np.maximum(total, 1), escape * below / np.maximum(rest, 1e-300))
            bits[first[order] + lo : first[order] + hi] = -np.log2(p)
            if order < ORDER:
                longer.append(p)
        shorter = np.concatenate(longer) if longer else shorter[:0]
    bits[:, -1, :] += np.log2(unseen)  # one byte of that class

    step = np.zeros((states, classes), dtype=np.int32)
    for order, contexts in enumerate(kept):
        for c, byte in enumerate(used.tolist()):
            goal = np.zeros(len(contexts), dtype=np.int64)
            for length in range(1, min(order + 1, ORDER) + 1):
                string = (contexts << 8 | byte) & ((1 << 8 * length) - 1)
                at = np.searchsorted(kept[length], string)
                there = (at < len(kept[length])) & (kept[length][np.minimum(at, max(len(kept[length]) - 1, 0))] == string) if len(kept[length]) else np.zeros(len(string), bool)
                goal = np.where(there, first[length] + at, goal)
            step[first[order] : first[order + 1], c] = goal
    return Model(list(languages), byte_class.astype(np.uint8), step, bits)


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits that each text takes in each language (texts x languages)."""
    out = np.zeros((len(texts), len(model.languages)))
    classes = model.step.shape[1]
    step, bits = model.step.reshape(-1), model.bits.reshape(-1, model.bits.shape[2])
    for lo, hi in steps([len(t) for t in texts]):
        data = np.frombuffer(b"".join(PAD + t for t in texts[lo:hi]), np.uint8)
        c = model.byte_class[data].astype(np.int32)
        state = np.zeros(len(c) - ORDER, dtype=np.int32)
        for k in range(ORDER):
            state = step[state * classes + c[k : len(c) - ORDER + k]]
        sizes = np.array([len(t) for t in texts[lo:hi]])
        starts = np.cumsum(sizes + ORDER) - sizes - ORDER
        cost = bits[state * classes + c[ORDER:]]
        # Between two texts stand the next one's pads, which cost nothing.
        own = np.concatenate([cost, np.zeros((ORDER, cost.shape[1]), np.float32)])
        running = np.add.reduceat(own, np.stack([starts, np.minimum(starts + sizes, len(own) - 1)], axis=1).reshape(-1), axis=0, dtype=np.float64)[::2]
        out[lo:hi] = np.where(sizes[:, None] > 0, running, 0)
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte for every whole text.

    ``score`` is the posterior of the chosen language among the learned ones, all equally likely
    before. A null text, or one without a letter, is ``und`` with score 0, and so is every
    text if nothing was learned. Equal code lengths go to the first language by name.
    """
    shared = model.shared(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            texts = encoded(batch.column(2))
            letters = pc.fill_null(pc.match_substring_regex(batch.column(2).cast(pa.large_string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if m.languages:
                cost = code_lengths(m, texts)
                best = cost.argmin(axis=1)
                least = cost.min(axis=1)
                value = 1 / np.exp2(np.maximum(least[:, None] - cost, -1000)).sum(axis=1)
                names = np.array(m.languages, dtype=object)[best]
            else:
                letters = np.zeros(len(texts), bool)
                least, value, names = np.zeros(len(texts)), np.zeros(len(texts)), np.full(len(texts), UNKNOWN, dtype=object)
            names = np.where(letters, names, UNKNOWN)
            per_byte = np.where(letters, least / np.maximum([len(t) for t in texts], 1), 0.0)
            columns = [batch.column(0), batch.column(1), pa.array(names.tolist(), pa.string()), pa.array(np.where(letters, value, 0.0)), pa.array(per_byte)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(tidy(score), "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")


def usual_bits(docs: DataFrame, model: Model) -> dict[str, float]:
    """Median code length per byte of the held-out labelled texts, by the language predicted."""
    held = docs.filter(held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    found = predict(held, model).filter(F.col("score") > 0).groupBy("lang_pred")
    return {r[0]: r[1] for r in found.agg(F.percentile_approx("bits_per_byte", 0.5)).collect()}  # a row for each language


def identified(docs: DataFrame, model: Model, least_score: float = 0.5, most: float = MOST_TIMES) -> DataFrame:
    """The documents whose language is recognised, all columns as they were.

    Rejected are null and empty texts, texts without a letter, those whose best language is not even as
    likely as all others together, and those that take more than ``most`` times the bits per
    byte usual in that language, such as random strings and scripts that were not learned. A language
    without held-out rows has no such limit. Repeated rows are judged each; an empty table stays
    empty; further columns of any name stay. Only the text goes to Python, in steps.
    """
    usual = usual_bits(docs, model)
    limits = np.array([most * usual.get(name, np.inf) for name in model.languages])
    shared = model.shared(docs.sparkSession)

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        m, out = Model(*shared.value), []
        for at in range(0, len(texts), ROWS):
            part = texts.slice(at, ROWS)
            letters = pc.fill_null(pc.match_substring_regex(part, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if not m.languages:
                out.append(np.zeros(len(part), bool))
                continue
            data = encoded(part)
            cost = code_lengths(m, data)
            best, least = cost.argmin(axis=1), cost.min(axis=1)
            score = 1 / np.exp2(np.maximum(least[:, None] - cost, -1000)).sum(axis=1)
            per_byte = least / np.maximum([len(t) for t in data], 1)
            out.append(letters & (score >= least_score) & (per_byte <= limits[best]))
        released()
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return docs.filter(known("text"))
