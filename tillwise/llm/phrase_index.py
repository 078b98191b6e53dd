"""Benchmark decontamination with a distributed positional inverted index.

All words of the training texts are stored with their places. A window of test words is looked up
by its rarest word in a segment: that word's places, less its offset in the window, are the
candidates, and the places of the other words, less theirs, are intersected with them from the
rarer to the more frequent. Proximity matches allow gaps between the words, in order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.positional_index import Segment, asked, build, loaded, query_blocks

#: Consecutive words of a test item that make a match; a shorter item is one window.
WINDOW = 10

SPAN = "struct<item_id: string, first: int, beyond: int>"
FOUND = f"segment long, row int, doc_id long, n_words long, spans array<{SPAN}>"


def windows(own: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    return [tuple(own[i : i + size]) for i in range(max(len(own) - size, 0) + 1)] if own else []


def phrase(lists: list[np.ndarray]) -> np.ndarray:
    """Places where the words with these places stand one after the other."""
    by_size = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    starts = lists[by_size[0]] - by_size[0]
    for k in by_size[1:]:
        if not len(starts):
            break
        at = np.searchsorted(lists[k], starts + k)
        starts = starts[lists[k][np.minimum(at, len(lists[k]) - 1)] == starts + k]
    return starts


def nearby(lists: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of stretches of at most ``most`` places with these words in order.

    From each place of the rarest word the nearest ones of the others are taken on both sides.
    """
    rare = min(range(len(lists)), key=lambda k: len(lists[k]))
    first = last = lists[rare]
    for k in range(rare + 1, len(lists)):
        at = np.searchsorted(lists[k], last, side="right")
        fine = at < len(lists[k])
        first, last = first[fine], lists[k][at[fine]]
    for k in range(rare - 1, -1, -1):
        at = np.searchsorted(lists[k], first, side="left") - 1
        fine = at >= 0
        first, last = lists[k][at[fine]], last[fine]
    fine = last - first < most
    return first[fine], last[fine]


def spans_of(segment: Segment, wanted: dict[tuple[bytes, ...], list[str]], slop: int) -> list[list[tuple[str, int, int]]]:
    """For each document the (item, first word, word beyond) of all stretches that match, joined where they meet."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in segment.ids]
    found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for window, items in wanted.items():
        lists = [segment.places.get(t) for t in window]
        if any(x is None for x in lists):
            continue
        if slop:
            first, last = nearby(lists, len(window) + slop)
            same = segment.doc_of(first) == segment.doc_of(last)
            first, last = first[same], last[same]
        else:
            first = phrase(lists)
            last = first + len(window) - 1
        if len(first):
            for item in items:
                found.setdefault(item, []).append((first, last))
    for item, parts in found.items():
        first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(first, kind="stable")
        first, reach = first[order], np.maximum.accumulate(last[order])
        new = np.flatnonzero(np.append(True, first[1:] > reach[:-1] + 1))
        ends = reach[np.append(new[1:], len(first)) - 1]
        docs = segment.doc_of(first[new])
        base = segment.start[docs]
        for d, a, b in zip(docs.tolist(), (first[new] - base).tolist(), (ends - base + 1).tolist(), strict=True):
            out[d].append((item, a, b))
    return out


def looker(spark: SparkSession, wanted: dict[tuple[bytes, ...], list[str]], slop: int) -> Callable[[pa.Table], pa.Table]:
    """Looks up a block of windows in one segment's rows."""
    shared = spark.sparkContext.broadcast(wanted)
    kind = pa.list_(pa.struct([("item_id", pa.string()), ("first", pa.int32()), ("beyond", pa.int32())]))

    def look_up(rows: pa.Table) -> pa.Table:
        segment, key = loaded(rows), rows.column("segment")[0].as_py()
        found, n = spans_of(segment, shared.value, slop), len(segment.ids)
        spans = pa.array([[{"item_id": i, "first": a, "beyond": b} for i, a, b in x] for x in found], kind)
        columns = [pa.array([key] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(segment.ids, pa.int64()), pa.array(segment.sizes, pa.int64()), spans]
        return pa.Table.from_arrays(columns, names=["segment", "row", "doc_id", "n_words", "spans"])

    return look_up


def matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document of the index: segment, row, doc_id, n_words and the ``spans`` of matching words.

    A span is (item_id as text, first word, word beyond) of words covered by windows of that item, as
    they stand; with ``slop`` also windows in order with so many further words between them.
    Items are held against all segments in blocks of bounded size.
    """
    spark, out = index.sparkSession, None
    blocks = 0
    for queries, _ in query_blocks(items):
        wanted: dict[tuple[bytes, ...], list[str]] = {}
        for item, own in queries:
            for w in windows(own, window):
                if item not in wanted.setdefault(w, []):
                    wanted[w].append(item)
        part = asked(index, {t for w in wanted for t in w}).groupBy("segment").applyInArrow(looker(spark, wanted, slop), FOUND)
        out, blocks = part if out is None else out.unionByName(part), blocks + 1
    if blocks > 1:
        grouped = out.groupBy("segment", "row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"))
        out = grouped.select("segment", "row", "doc_id", "n_words", "spans")
    return out


def covered(spans: Column) -> Column:
    """Words inside any span."""
    bounds = F.array_sort(F.transform(spans, lambda s: F.struct(s["first"].alias("first"), s["beyond"].alias("beyond"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    more = lambda a, s: F.struct(
        F.greatest(a["end"], s["beyond"]).alias("end"),
        (a["n"] + F.greatest(s["beyond"] - F.greatest(a["end"], s["first"]), F.lit(0))).alias("n"),
    )
    return F.aggregate(bounds, start, more)["n"]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every whole text.

    Null and empty texts have no words; repeated rows are documents of their own, a null id
    stays null; items with one id count once, without words never, a null item id counts as empty
    text; other columns are ignored; an empty table gives no rows. A very long text is a segment
    of its own.
    """
    found = matches(build(docs), items, window, slop)
    hit = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    out = found.select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), hit.alias("items"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
item AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM benchmark),
tests AS (
  SELECT DISTINCT item_id, least(len(words), {WINDOW}) AS size, array_to_string(words[i : i + least(len(words), {WINDOW}) - 1], ' ') AS gram
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - {WINDOW} + 1, 1) + 1)) AS i FROM item WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT size FROM tests),
starts AS (
  SELECT rid, size, i, array_to_string(words[i : i + size - 1], ' ') AS gram
  FROM (SELECT rid, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM doc, lengths)),
hits AS (SELECT rid, size, i, item_id FROM starts JOIN tests USING (size, gram)),
words AS (SELECT rid, count(DISTINCT w) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS w FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
