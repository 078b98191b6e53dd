"""Document fingerprints by content-defined chunking.

A gear hash over the bytes ends a chunk where its masked bits are zero: a stricter mask before
the normal size and a looser one behind it keep the sizes close together. The fingerprint is the
set of chunk digests with their lengths, so text that moves keeps its chunks, and the weight of
common chunks against the smaller text's weight measures containment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import gear_hash, gear_table, steps

#: Chunk sizes in bytes, and the mask bits before and behind the normal size.
SHORTEST, NORMAL, LONGEST = 16, 48, 256
STRICT, LOOSE = np.uint32(0x7F << 20), np.uint32(0x0F << 20)
_TABLE = gear_table(5)

Chunks = dict[int, int]


def boundaries(texts: list[bytes]) -> list[list[int]]:
    """Chunk ends of each text."""
    out: list[list[int]] = [[] for _ in texts]
    for lo, hi in steps([len(t) for t in texts]):
        data = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
        if not len(data):
            continue
        h = gear_hash(data, _TABLE)
        loose = np.flatnonzero((h & LOOSE) == 0)
        strict = (h[loose] & STRICT) == 0
        bounds = np.cumsum([0] + [len(t) for t in texts[lo:hi]])
        # The hash of a text's first bytes must not depend on the text before it: no chunk ends
        # within the hash's window there, as the first 32 bytes are never candidates.
        cut = np.searchsorted(loose, bounds)
        for i in range(hi - lo):
            start, size = 0, len(texts[lo + i])
            ends = out[lo + i]
            for at, hard in zip((loose[cut[i] : cut[i + 1]] - bounds[i] + 1).tolist(), strict[cut[i] : cut[i + 1]].tolist(), strict=True):
                if at < 32:
                    continue
                while at - start > LONGEST:
                    start += LONGEST
                    ends.append(start)
                if at - start >= (SHORTEST if hard else NORMAL):
                    ends.append(at)
                    start = at
            while size - start > LONGEST:
                start += LONGEST
                ends.append(start)
            if size > start:
                ends.append(size)
    return out


def chunk_sets(texts: list[bytes]) -> list[Chunks]:
    """For each text the 64-bit digests of its distinct chunks, with their lengths in bytes."""
    digest = xxhash.xxh3_64_intdigest
    out = []
    for text, ends in zip(texts, boundaries(texts), strict=True):
        found: Chunks = {}
        start = 0
        for end in ends:
            found[digest(text[start:end])] = end - start
            start = end
        out.append(found)
    return out


def as_text(chunks: Chunks) -> str:
    """The fingerprint: digest and length of each chunk in hexadecimal, by digest."""
    return "".join(f"{d:016x}{n:03x}" for d, n in sorted(chunks.items()))


def from_text(fingerprint: str) -> Chunks:
    return {int(fingerprint[i : i + 16], 16): int(fingerprint[i + 16 : i + 19], 16) for i in range(0, len(fingerprint), 19)}


def likeness(a: Chunks, b: Chunks) -> float:
    """Weight of the common chunks over the weight of the lighter set; two empty sets are alike."""
    if not a or not b:
        return float(not a and not b)
    if len(a) > len(b):
        a, b = b, a
    return sum(n for d, n in a.items() if d in b) / min(sum(a.values()), sum(b.values()))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared(docs: list[int | None], texts: list[str], nexts: list[str]) -> pa.RecordBatch:
    """Result rows of texts, each beside the one that follows it."""
    changed = [edited(a, b) for a, b in zip(texts, nexts, strict=True)]
    own, new = chunk_sets([t.encode() for t in texts]), chunk_sets([t.encode() for t in changed])
    # Mostly the next text is the next row's.
    after = [own[i + 1] if i + 1 < len(own) and nexts[i] is texts[i + 1] else chunk_sets([n.encode()])[0] for i, n in enumerate(nexts)]
    columns = [
        pa.array(docs, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([as_text(c) for c in own], pa.string()), pa.array([as_text(c) for c in new], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, new, strict=True)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, after, strict=True)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _RESULT.split(", ")])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every whole text of ``doc_id, text`` beside its edited text and the next document.

    Documents follow each other by ascending doc_id (null first, repeated ids by text); the last
    is followed by the first, an only one by itself. Null text counts as empty; further columns
    are ignored; an empty table gives no rows. Ranges of ids, bounded by quantiles, are sorted
    each in a task of its own; the first document of the next range is added to each range
    (one row for each range, whatever the number of documents).
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = np.unique(np.array(rows.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] or [], dtype=np.int64))

    placed = rows.mapInArrow(in_ranges(bounds), "doc_id long, text string, part int")
    order = ["doc_id", "text"]
    firsts = rows.select("doc_id").mapInArrow(in_ranges(bounds), "doc_id long, part int")
    firsts = sorted((r["part"], r["least"], r["nulls"]) for r in firsts.groupBy("part").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect())
    heads = [(p, None if nulls else least, firsts[i - 1][0]) for i, (p, least, nulls) in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "part int, head long, of int")
    followers = (
        rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("of", "doc_id").agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.col("of").alias("part"), F.lit(True).alias("follows"))
    )
    both = placed.withColumn("follows", F.lit(False)).unionByName(followers)
    both = both.repartition(parts, "part").sortWithinPartitions("part", "follows", *(F.col(c).asc_nulls_first() for c in order))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            ids, texts, where, follows = (batch.column(i).to_pylist() for i in range(4))
            if before is not None:
                ids, texts, where, follows = ([b, *c] for b, c in zip(before, (ids, texts, where, follows), strict=True))
            if not ids:
                continue
            before = ids[-1], texts[-1], where[-1], follows[-1]
            for lo, hi in steps([len(t) for t in texts[:-1]]):
                found = compared(ids[lo:hi], texts[lo:hi], texts[lo + 1 : hi + 1])
                yield found.filter(pa.array([not f for f in follows[lo:hi]]))

    return both.mapInArrow(pair, _RESULT)


def in_ranges(bounds: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the number of the range that the first column lies in; null is below all."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            at = np.searchsorted(bounds, ids, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "part"])

    return place
