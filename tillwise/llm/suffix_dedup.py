"""Removal of repeated byte strings by deep-shallow sorting of sparse suffixes.

A byte goes if a string of 200 bytes that covers it starts anywhere else as well. Every such
string holds an anchor: of its 101 strings of 100 bytes, the leftmost with the least hash.
Equal strings have their anchor at the same place, so only texts around anchors of equal hash
can match. These texts are sorted both ways from the anchor: multikey quicksort down to a
shallow depth, then blind tries for the groups that agree so far. The common prefixes found
give, for each anchor, which of the 101 strings around it stand elsewhere too.

Steps: (1) count anchor hashes; (2) for the anchors met again, count the hash of their whole
surroundings: equal surroundings need no sorting; (3) sort one of each different surroundings;
(4) bring the repeated stretches back to the documents.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import bitmap, encoded, free, gear_table, mixed, split_by, steps, tidy
from tillwise.staging import stage

LENGTH = 200
GRAM = 100
#: Places an anchor may have in a string.
PLACES = LENGTH - GRAM + 1
SHALLOW = 8
#: Different surroundings of one anchor hash that are sorted together; beyond that the strings
#: around the anchors are dealt out one by one, by their own hashes.
GROUP_ROWS = 20_000
#: Surroundings that one vectorised step sorts.
SORT_ROWS = 1 << 14

_ODD, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Hasher:
    """Hashes of any stretches of a byte array, from running sums."""

    def __init__(self, data: np.ndarray, seed: int) -> None:
        n = len(data)
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _ODD)]), dtype=np.uint64)
        self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]), dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(gear_table(seed)[data] * up[:n], dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] ^ (end - start).astype(np.uint64))


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, Hasher]:
    """Positions of all anchors in texts that follow each other, and their hashes."""
    hasher = Hasher(data, 11)
    n = len(data) - GRAM + 1
    if n < PLACES:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), hasher
    start = np.arange(n)
    h = hasher.of(start, start + GRAM)
    bits = max(int(n).bit_length(), 28)  # the same for all but enormous texts, as places must agree
    ranked = (h >> np.uint64(bits) << np.uint64(bits)) | start.astype(np.uint64)
    # Least of each PLACES in a row: running minima from both ends of blocks.
    blocks = -(-n // PLACES)
    padded = np.full(blocks * PLACES, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = ranked
    padded = padded.reshape(blocks, PLACES)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    strings = n - PLACES + 1
    least = np.minimum(back[:strings], ahead[PLACES - 1 : PLACES - 1 + strings])
    # Strings may not run over the end of their text.
    doc_end = np.repeat(bounds[1:], np.diff(bounds))[:strings]
    inside = start[:strings] + LENGTH <= doc_end
    at = (least[inside] & np.uint64((1 << bits) - 1)).astype(np.int64)
    at = np.unique(at)
    return at, h[at], hasher


def surroundings(at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number of each anchor, and how far its surroundings reach within the text."""
    doc = np.searchsorted(bounds, at, side="right") - 1
    return doc, np.maximum(at - (LENGTH - GRAM), bounds[doc]), np.minimum(at + LENGTH, bounds[doc + 1])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def _check(text: bytes) -> int:
    return zlib.crc32(text)


def anchor_hashes(docs: DataFrame) -> DataFrame:
    """The hash of every anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encoded(batch.column(0))
            for lo, hi in steps([len(t) for t in texts]):
                bounds = np.cumsum([0] + [len(t) for t in texts[lo:hi]])
                _, h, _ = anchors(np.frombuffer(b"".join(texts[lo:hi]), np.uint8), bounds)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["key"])

    return docs.select("text").mapInArrow(tidy(find), "key long")


def anchor_rows(docs: DataFrame) -> DataFrame:
    """key, around (hash of the surroundings), doc_id and at: position and text check in one."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = encoded(batch.column(1)), batch.column(0)
            for lo, hi in steps([len(t) for t in texts]):
                bounds = np.cumsum([0] + [len(t) for t in texts[lo:hi]])
                data = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
                at, h, _ = anchors(data, bounds)
                doc, left, right = surroundings(at, bounds)
                around = Hasher(data, 12).of(left, right) + mixed((at - left).astype(np.uint64) + np.uint64(1))
                check = np.array([_check(t) for t in texts[lo:hi]], dtype=np.int64)
                place = (at - bounds[doc]) << 32 | check[doc] if len(at) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(around.view(np.int64)), ids.slice(lo, hi - lo).take(pa.array(doc)), pa.array(place)],
                    names=["key", "around", "doc_id", "at"],
                )

    return _rows(docs).mapInArrow(tidy(find), "key long, around long, doc_id long, at long")


def deep_shallow(texts: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of bytes within their groups; all groups go on in step.

    Returns the order and, for each place of it, the length of the common prefix with the row
    before (-1 at the start of a group). Multikey quicksort parts each group by the middle
    row's byte into smaller, equal and larger; the equal part goes one byte deeper. Groups that
    agree down to ``shallow`` bytes go to blind tries: the first place where any row differs
    from the first is a branching byte, looked at alone; its children are tries of their own.
    """
    n, width = texts.shape
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    prefix = np.zeros(n, dtype=np.int64)
    head = np.r_[True, sorted_group[1:] != sorted_group[:-1]] if n else np.zeros(0, bool)
    prefix[head] = -1
    start = np.flatnonzero(head)
    end = np.r_[start[1:], n] if n else start
    depth = np.zeros(len(start), dtype=np.int64)
    shallow = min(shallow, width)

    def parted(s: np.ndarray, e: np.ndarray, d: np.ndarray, codes: np.ndarray, rows: np.ndarray, at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        """Order the rows of the active groups by code; the parts' starts, ends, owners and codes."""
        rank = np.lexsort((codes, owner))
        order[at] = rows[rank]
        codes = codes[rank]
        cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (codes[1:] != codes[:-1])])
        inner = cut[np.r_[False, owner[cut][1:] == owner[cut][:-1]]] if len(cut) else cut
        prefix[at[inner]] = d[owner[inner]]
        stop = np.r_[cut[1:], len(at)]
        return at[cut], at[stop - 1] + 1, owner[cut], codes[cut]

    def active(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = e - s
        owner = np.repeat(np.arange(len(s)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(s, size)
        return at, owner

    deep_start, deep_end = [], []
    while True:  # multikey quicksort
        many = end - start > 1
        start, end, depth = start[many], end[many], depth[many]
        done = depth >= shallow
        deep_start.append(start[done])
        deep_end.append(end[done])
        start, end, depth = start[~done], end[~done], depth[~done]
        if not len(start):
            break
        at, owner = active(start, end)
        rows = order[at]
        byte = texts[rows, depth[owner]]
        pivot = texts[order[(start + end) // 2], depth]
        codes = np.sign(byte.astype(np.int32) - pivot[owner].astype(np.int32))
        s, e, own, code = parted(start, end, depth, codes, rows, at, owner)
        start, end, depth = s, e, depth[own] + (code == 0)
    start, end = np.concatenate(deep_start), np.concatenate(deep_end)
    while len(start):  # blind tries
        at, owner = active(start, end)
        rows, first = order[at], order[start][owner]
        differs = texts[rows] != texts[first]
        where = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        branch = np.minimum.reduceat(where, np.r_[0, np.cumsum(end - start)[:-1]])
        alike = branch == width
        same = alike[owner]
        prefix[at[same & (at != start[owner])]] = width
        at, owner, rows = at[~same], owner[~same], rows[~same]
        if not len(at):
            break
        codes = texts[rows, branch[owner]].astype(np.int32)
        s, e, _, _ = parted(start, end, branch, codes, rows, at, owner)
        many = e - s > 1
        start, end = s[many], e[many]
    return order, prefix


def repeated_places(group: np.ndarray, left: list[bytes], right: list[bytes]) -> np.ndarray:
    """For each row and place: is the string that has the anchor there also around another row?

    ``left`` ends before the anchor, ``right`` starts at it; both are cut at the text's ends.
    """
    n, reach = len(group), LENGTH - GRAM
    after, before = np.full((n, LENGTH), 256, np.int16), np.full((n, reach), 256, np.int16)
    size_r, size_l = np.array([len(r) for r in right]), np.array([len(v) for v in left])
    for i in range(n):
        after[i, : size_r[i]] = np.frombuffer(right[i], np.uint8)
        before[i, : size_l[i]] = np.frombuffer(left[i], np.uint8)[::-1]
    order_r, prefix_r = deep_shallow(after, group)
    order_l, prefix_l = deep_shallow(before, group)
    out = np.zeros((n, PLACES), dtype=bool)
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(PLACES):
        class_r[order_r] = np.cumsum(prefix_r < LENGTH - o)
        class_l[order_l] = np.cumsum(prefix_l < o)
        valid = np.flatnonzero((size_l >= o) & (size_r >= LENGTH - o))
        both = class_r[valid] * np.int64(n + 1) + class_l[valid]
        _, which, count = np.unique(both, return_inverse=True, return_counts=True)
        out[valid, o] = count[which] > 1
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


_STRETCH = "key long, around long, low int, high int"


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated places of all anchors in a partition sorted by key, whole groups at a time."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        group = np.unique([r[0] for r in rows], return_inverse=True)[1].reshape(-1)
        found = repeated_places(group, [r[2] for r in rows], [r[3] for r in rows])
        out = [(r[0], r[1], lo, hi) for r, flags in zip(rows, found, strict=True) for lo, hi in runs(flags)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "around", "low", "high"])

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if len(held) >= SORT_ROWS and row[0] != held[-1][0]:
                yield solve(held)
                held = []
            held.append(row)
    if held:
        yield solve(held)


def _string_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of 200 bytes around an anchor of a very common hash, as its 128-bit hash."""
    for batch in batches:
        keys, arounds, places, strings = [], [], [], []
        for key, around, left, right in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            text = left + right
            for o in range(max(0, LENGTH - len(right)), min(len(left), LENGTH - GRAM) + 1):
                keys.append(key)
                arounds.append(around)
                places.append(o)
                strings.append(hashlib.md5(text[len(left) - o : len(left) - o + LENGTH], usedforsecurity=False).digest())
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip((keys, arounds, places, strings), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "around", "low", "string"])


def stretches(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Repeated stretches: doc_id, check (of the text), and byte ranges [start, end)."""
    again = anchor_hashes(docs).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    again = stage(again, "suffix-again")
    near, _ = split_by(anchor_rows(docs), bitmap(again, "key"), "key")
    met = stage(near.join(again, "key", "left_semi"), "suffix-anchors")

    kinds = met.groupBy("key", "around").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at")).alias("one"))
    kinds = stage(kinds.select("key", "around", "n", "one.doc_id", "one.at"), "suffix-kinds")
    several = kinds.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1")

    # Only one of each different surroundings is fetched from its text and sorted.
    wanted = stage(kinds.join(several, "key"), "suffix-wanted")
    check = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    spots = wanted.withColumn("check", check).groupBy("doc_id", "check").agg(F.collect_list(F.struct("key", "around", "at", "kinds")).alias("spots"))
    spots = spots.withColumnRenamed("doc_id", "__doc").withColumnRenamed("check", "__check")
    checked = docs_checked(docs)
    some, _ = split_by(checked, bitmap(wanted.select("doc_id", check.alias("check")), "doc_id", "check"), "doc_id", "check")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spot in zip(encoded(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                for s in spot:
                    at = s["at"] >> 32
                    rows.append((s["key"], s["around"], text[max(0, at - LENGTH + GRAM) : at], text[at : at + LENGTH], s["kinds"]))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=["key", "around", "left", "right", "kinds"]
            )

    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("check") == F.col("__check"))
    fetched = some.join(spots, on).select("text", "spots").mapInArrow(tidy(fetch), "key long, around long, left binary, right binary, kinds long")
    fetched = fetched.dropDuplicates(["key", "around"])  # rows that stand twice in the table
    fetched = stage(fetched, "suffix-texts")
    small = fetched.filter(F.col("kinds") <= group_rows).select("key", "around", "left", "right")
    sorted_out = small.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_sorted_groups), _STRETCH)
    strings = fetched.filter(F.col("kinds") > group_rows).select("key", "around", "left", "right")
    strings = strings.mapInArrow(tidy(_string_hashes), "key long, around long, low int, string binary")
    # By anchor and place too: one string may hold several anchors, and is then dealt out by each.
    same = ["key", "low", "string"]
    twice = strings.groupBy(*same).agg(F.count("*").alias("n")).filter("n > 1").select(*same)
    dealt = strings.join(twice, same, "left_semi").select("key", "around", "low", F.col("low").alias("high"))
    equal = kinds.filter("n > 1").select("key", "around", F.lit(0).alias("low"), F.lit(PLACES - 1).alias("high"))
    found = sorted_out.unionByName(dealt).unionByName(equal)
    found = found.groupBy("key", "around").agg(F.collect_list(F.struct("low", "high")).alias("places"))  # at most one for each place
    found = stage(found, "suffix-found")  # then a common anchor's rows can be split in the join
    hits = met.join(found, ["key", "around"]).select("doc_id", check.alias("check"), F.shiftright("at", 32).alias("at"), F.explode("places").alias("p"))
    # Places low .. high cover one stretch; it is cut to the text when it is applied.
    return hits.select(
        "doc_id", "check", (F.col("at") - F.col("p.high")).alias("start"), (F.col("at") - F.col("p.low") + LENGTH).alias("end")
    )


def docs_checked(docs: DataFrame) -> DataFrame:
    """doc_id, text and the check of the text that tells repeated ids apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), "text", F.crc32(text).alias("check"))


def merged(size: int, spots: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((max(0, s["start"]), min(size, s["end"])) for s in spots):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _with_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with repeated stretches (in a last column), and those without any."""
    found = stretches(docs).groupBy("doc_id", "check").agg(F.collect_set(F.struct("start", "end")).alias("spots"))
    found = stage(found, "suffix-stretches")
    check, key, doc, of, spots = (free(docs, c) for c in ("check_sum", "long_id", "found_id", "found_sum", "found_spots"))
    base = docs.withColumn(check, F.crc32(F.coalesce("text", F.lit("")))).withColumn(key, F.col("doc_id").cast("long"))
    names = found.select(F.col("doc_id").alias(doc), F.col("check").alias(of), F.col("spots").alias(spots))
    some, none = split_by(base, bitmap(found, "doc_id", "check"), key, check)
    on = F.col(key).eqNullSafe(F.col(doc)) & (F.col(check) == F.col(of))
    both = some.join(names, on, "left")
    return both.select(*[both[c] for c in docs.columns], both[spots]), none.drop(check, key)


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the spans for every document.

    Null text counts as empty, texts below 200 bytes lose nothing of their own; a text that
    stands in two rows repeats itself and goes whole; further columns are ignored; an empty
    table gives no rows.
    """
    some, none = _with_spans(_rows(docs))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, spots in zip(batch.column(0).to_pylist(), encoded(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                spans = merged(len(text), spots or [])
                kept = kept_bytes(text, spans)
                rows.append((doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [list(s) for s in spans]))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.list_(pa.int64()))]
            names = [f.split()[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    empty = F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("found_spots")
    return some.mapInArrow(tidy(apply), schema).unionByName(none.select("*", empty).mapInArrow(tidy(apply), schema))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated stretches, all columns in place, n_chars of what stays.

    A character that is cut in two goes whole. A document that loses all its text, white space
    aside, goes; one that had none before stays.
    """
    some, none = _with_spans(docs)
    names = docs.columns
    at = names.index("text")
    chars = names.index("n_chars") if "n_chars" in names else None

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spots = encoded(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist()
            kept = [kept_bytes(t, merged(len(t), s or [])).decode("utf-8", "ignore") if s else None for t, s in zip(texts, spots, strict=True)]
            old = batch.column(at).to_pylist()
            new = [o if k is None else k for o, k in zip(old, kept, strict=True)]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(new, batch.column(at).type)
            if chars is not None:
                said = batch.column(chars).to_pylist()
                sizes = [s if k is None else len(k) for s, k in zip(said, kept, strict=True)]
                columns[chars] = pa.array(sizes, batch.column(chars).type)
            stays = pa.array([k is None or bool(k.strip()) for k in kept])
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(stays)

    return some.mapInArrow(tidy(apply), docs.schema).unionByName(none.select(*names))
