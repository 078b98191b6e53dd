"""SimHash near-duplicates by a self-join of binary tries.

Two fingerprints with at most 3 differing bits agree on at least 2 of 5 blocks of bits, so
each pair of blocks deals all distinct fingerprints out by those blocks' value, and within
one value the rest of the bits forms a binary trie that is joined with itself: pairs of nodes
go down together, adding up differing bits, and end where the sum exceeds the budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import free, tidy
from tillwise.staging import stage

BUDGET = 3
WORDS = 3
#: Five blocks of the 64 bits, as (lowest bit, bits).
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of one trie; a larger one is split by its next bits, pair of branches by pair.
TRIE_ROWS = 4096
SPLIT_BITS = 6

_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """64-bit hashes of the word shingles, repeats included; all words if there are fewer."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype="<u8")


def simhash(hashes: np.ndarray) -> int:
    """64-bit SimHash of shingle hashes; zero without any."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the word shingles, repeats included; zero without words."""
    return simhash(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = WORDS, *further: Column) -> DataFrame:
    """doc_id, ``further`` columns and the fingerprint ``fp`` as a signed 64-bit number."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in batch.column(0).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values.view(np.int64))], names=[*batch.schema.names[1:], "fp"])

    rows = docs.select("text", F.col("doc_id").cast("long"), *further)
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("fp", T.LongType())])
    return rows.mapInArrow(tidy(make), schema)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def trie_pairs(group: np.ndarray, side: np.ndarray, rest: np.ndarray, spent: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows within the budget, from many tries joined with themselves at once.

    ``group`` says which trie a row is in, ``spent`` how many bits its branch pair has used up.
    Rows of side 0 and 1 meet (two branches); a group of side 0 alone meets itself. Rows come
    sorted by group, side and ``rest``, so a node of a trie is a run of rows.
    """
    node = group * 2 + side
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    last = np.r_[first[1:], len(node)]
    heads = group[first]
    two = np.flatnonzero(np.r_[heads[1:] == heads[:-1], False]) if len(first) else first
    alone = np.setdiff1d(np.arange(len(first)), np.r_[two, two + 1])
    alone = alone[side[first[alone]] == 0]
    a, b = np.r_[alone, two], np.r_[alone, two + 1]
    lo_a, hi_a, lo_b, hi_b = first[a], last[a], first[b], last[b]
    used, self_join = spent[lo_a].copy(), a == b
    at = bits
    while at > 0 and len(lo_a):
        step = min(4, at)
        at -= step
        digit = ((rest >> np.uint64(at)) & np.uint64((1 << step) - 1)).astype(np.int64)
        prefix = rest >> np.uint64(at)
        cut = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (node[1:] != node[:-1])])
        ends = np.r_[cut[1:], len(rest)]
        # Children of each node: runs of equal prefix inside it.
        ca, cb = np.searchsorted(cut, lo_a), np.searchsorted(cut, lo_b)
        na, nb = np.searchsorted(cut, hi_a) - ca, np.searchsorted(cut, hi_b) - cb
        total = na * nb
        pair = np.repeat(np.arange(len(total)), total)
        within = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        x, y = ca[pair] + within // nb[pair], cb[pair] + within % nb[pair]
        cost = used[pair] + popcount((digit[cut[x]] ^ digit[cut[y]]).astype(np.uint64))
        keep = (cost <= BUDGET) & (~self_join[pair] | (x <= y))
        x, y, pair = x[keep], y[keep], pair[keep]
        lo_a, hi_a, lo_b, hi_b = cut[x], ends[x], cut[y], ends[y]
        used, self_join = cost[keep], self_join[pair] & (x == y)
        single = self_join & (hi_a - lo_a == 1)  # a row alone has no partner
        lo_a, hi_a, lo_b, hi_b, used, self_join = (v[~single] for v in (lo_a, hi_a, lo_b, hi_b, used, self_join))
    return lo_a, lo_b


def forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The least index each of ``n`` nodes is connected to."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], least)
        np.minimum.at(new, root[y], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of all tries in a partition sorted by trie; each trie's links as a forest."""

    def solve(frame: np.ndarray) -> pa.RecordBatch:
        key, side, fp, rest, spent, bits = frame
        out = []
        for width in np.unique(bits):
            on = bits == width
            g = np.unique(key[on], return_inverse=True)[1].reshape(-1)
            order = np.lexsort((rest[on].view(np.uint64), side[on], g))
            g, s, f = g[order], side[on][order], fp[on][order]
            i, j = trie_pairs(g, s, rest[on][order].view(np.uint64), spent[on][order], int(width))
            root = forest(i, j, len(f))
            linked = np.flatnonzero(root != np.arange(len(f)))
            out.append((f[linked], f[root[linked]]))
        a, b = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held: list[np.ndarray] = []
    for batch in batches:
        frame = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)])
        held.append(frame)
        if sum(h.shape[1] for h in held) >= 1 << 16:
            both = np.concatenate(held, axis=1)
            cut = int(np.flatnonzero(both[0] == both[0][-1])[0])  # the last trie may go on
            if cut:
                yield solve(both[:, :cut])
            held = [both[:, cut:]]
    if held:
        both = np.concatenate(held, axis=1)
        if both.shape[1]:
            yield solve(both)


def _without(fp: F.Column, blocks: tuple[int, int]) -> tuple[F.Column, F.Column, int]:
    """The value of two blocks, the other bits moved together, and how many those are."""
    key, rest, width = F.lit(0).cast("long"), F.lit(0).cast("long"), 0
    for i, (low, bits) in enumerate(BLOCKS):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1))
        if i in blocks:
            key = F.shiftleft(key, bits).bitwiseOR(part)
        else:
            rest = F.shiftleft(rest, bits).bitwiseOR(part)
            width += bits
    return key, rest, width


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose closure is that of all close pairs."""
    columns = []
    for n, pair in enumerate(combinations(range(len(BLOCKS)), 2)):
        key, rest, width = _without(F.col("fp"), pair)
        columns.append(F.struct(key.bitwiseOR(F.shiftleft(F.lit(n).cast("long"), 26)).alias("key"), rest.alias("rest"), F.lit(width).alias("bits")))
    dealt = distinct.select("fp", F.explode(F.array(*columns)).alias("t")).select("fp", "t.*")
    dealt = stage(dealt.select("fp", "key", "rest", "bits"), "simhash-tries")
    sizes = dealt.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    tries = stage(dealt.join(sizes, "key"), "simhash-groups")
    small = tries.filter(F.col("n") <= TRIE_ROWS).select(
        F.col("key").alias("trie"), F.lit(0).alias("side"), "fp", "rest", F.lit(0).alias("spent"), "bits"
    )
    # A larger trie: each row joins every pair of branches its next bits may belong to.
    masks = [m for m in range(1 << SPLIT_BITS) if m.bit_count() <= BUDGET]
    low = F.col("bits") - SPLIT_BITS
    branch = F.expr(f"cast(shiftrightunsigned(rest, bits - {SPLIT_BITS}) as long)")
    large = (
        tries.filter(F.col("n") > TRIE_ROWS)
        .withColumn("branch", branch)
        .withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        .withColumn("other", F.col("branch").bitwiseXOR(F.col("mask")))
        .select(
            F.xxhash64("key", "mask", F.least("branch", "other")).alias("trie"),
            (F.col("branch") > F.col("other")).cast("int").alias("side"),
            "fp",
            F.expr(f"rest & (shiftleft(1L, bits - {SPLIT_BITS}) - 1)").alias("rest"),
            F.bit_count("mask").alias("spent"),
            low.alias("bits"),
        )
    )
    both = small.unionByName(large).repartition("trie").sortWithinPartitions("trie")
    return both.mapInArrow(tidy(_joined), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and the least node it is connected to, for all nodes with an edge.

    Alternating large-star and small-star rounds; each writes its links to the shared folder.
    """
    def mark(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    current = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "component-links")
    before = mark(current)
    while True:
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least.withColumn("m", F.least("u", "m")), "u")
            .filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        new = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stage(new.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "component-links")
        before, last = mark(current), before
        if before == last:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def rooted(classes: DataFrame) -> DataFrame:
    """The rows of ``classes`` (one per ``fp``) with the ``root`` that linked fingerprints share."""
    linked = components(links(classes.select("fp")))
    return stage(classes.join(linked, F.col("fp") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "fp")), "simhash-roots")


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every document.

    Documents link at three or fewer differing bits; the component is named by its smallest
    doc_id. Null or empty text has fingerprint zero and links like any other; repeated rows are
    kept; a null doc_id names a component only where it has no other.
    """
    prints = stage(fingerprints(docs, words), "simhash-prints")
    roots = rooted(stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-classes"))
    named = roots.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_print = roots.join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents with one of each group of near-duplicates kept: its least doc_id.

    Groups are those of ``near_duplicates``: fingerprints linked at three or fewer differing bits,
    texts without words among them. Of repeated rows one stays, of rows of one doc_id the one whose
    text has the least MD5; a null doc_id is kept only where its group has no other. A very long text
    counts as a whole; an empty table stays empty; further columns of any name stay.
    """
    mark = F.coalesce(F.md5("text"), F.lit(""))
    prints = stage(fingerprints(docs, words, mark.alias("mark")), "simhash-prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    roots = rooted(stage(prints.groupBy("fp").agg(F.min(order).alias("first")), "simhash-classes"))
    own, doc, text = (free(docs, c) for c in ("own_mark", "kept_id", "kept_mark"))
    kept = roots.groupBy("root").agg(F.min("first").alias("first"))
    kept = stage(kept.select(F.col("first.doc_id").alias(doc), F.col("first.mark").alias(text)), "simhash-kept")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(text))
    return docs.withColumn(own, mark).join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
