"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

Documents lie in the segments of a positional index. In a segment each query reads the lists of
its terms in descending order of impact, a block of each list at a time. A document's lower
bound is the sum of what was read of it; its upper bound adds, for each list it was not met in,
the impact that list would yield next. Documents whose upper bound is below the bar (the 50th best
lower bound) are out; reading goes on until the two bounds of all others meet, so membership,
ties and scores are exact. A segment reports its best documents only, a small share of its
text's size whatever the number of segments, and the best of these are the best of all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.positional_index import Segment, asked, build, loaded, query_blocks

BEST = 50
#: Entries of each list in the first block of reads; each further block doubles the depth.
BLOCK = 64

FOUND = "query int, doc_id long, score long"
Query = tuple[str, list[bytes]]


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Lists:
    """Impact-sorted lists of a segment, each sorted when it is first asked for."""

    def __init__(self, segment: Segment, documents: int, length: int) -> None:
        self.segment, self.sorted = segment, {}
        self.m = 50 + (50 * segment.sizes * documents) // max(length, 1)
        self.documents = len(segment.sizes)

    def of(self, term: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        if term not in self.sorted:
            places = self.segment.places.get(term)
            if places is None:
                self.sorted[term] = None
            else:
                docs, tf = np.unique(self.segment.doc_of(places), return_counts=True)
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * self.m[docs])
                order = np.argsort(-impact, kind="stable")
                self.sorted[term] = docs[order], impact[order]
        return self.sorted[term]


def read(lists: Lists, terms: list[tuple[bytes, int]], best: int = BEST, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a segment with their exact scores: all that score as high as the ``best``-th.

    ``terms`` carry their weights. Documents of score 0 are left out.
    """
    there = [(found[0], found[1] * w) for t, w in terms if w > 0 and (found := lists.of(t)) is not None]
    lower, depth = np.zeros(lists.documents, dtype=np.int64), np.zeros(len(there), dtype=np.int64)
    bar, upto = 1, block
    while True:
        heads = [int(gain[at]) if at < len(gain) else 0 for (_, gain), at in zip(there, depth, strict=True)]
        most = sum(heads)  # what a document not met so far can still reach
        missing = np.full(lists.documents, most, dtype=np.int64)
        for (docs, _), at, head in zip(there, depth, heads, strict=True):
            missing[docs[:at]] -= head
        if len(lower) > best:
            bar = max(bar, int(np.partition(lower, -best)[-best]))
        alive = np.flatnonzero(lower + missing >= bar)
        if not missing[alive].any():
            return alive, lower[alive]
        for j, (docs, gain) in enumerate(there):
            lower[docs[depth[j] : upto]] += gain[depth[j] : upto]
            depth[j] = min(upto, len(docs))
        upto *= 2


def search(index: DataFrame, queries: list[Query], best: int = BEST) -> DataFrame:
    """The ``best`` documents of each query of one block: query (its number), rank, doc_id, score."""
    spark = index.sparkSession
    terms = sorted({t for _, own in queries for t in own})
    members = index.filter("term is null").agg(F.sum("docs"), F.sum("n")).first()
    documents, length = members[0] or 0, members[1] or 0
    frequency = asked(index, set(terms)).filter("term is not null").groupBy("term").agg(F.sum("docs")).collect()  # a row for each term of the block
    weights = {bytes(t): weight(documents, df) for t, df in frequency}
    weighed = [sorted(((t, weights[t]) for t in set(own) if t in weights), key=lambda x: (-x[1], x[0])) for _, own in queries]

    def best_here(rows: pa.Table) -> pa.Table:
        lists = Lists(loaded(rows), documents, length)
        ids, out = lists.segment.ids, []
        for q, own in enumerate(shared.value):
            docs, scores = read(lists, own, best)
            local = sorted((-s, ids[d] is None, ids[d] or 0, d) for d, s in zip(docs.tolist(), scores.tolist(), strict=True))
            out += [(q, ids[d], -s) for s, _, _, d in local[:best]]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("query", "doc_id", "score"), list(zip(*out, strict=True)) or [()] * 3, kinds, strict=True)})

    shared = spark.sparkContext.broadcast(weighed)
    found = asked(index, set(weights)).groupBy("segment").applyInArrow(best_here, FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def rank(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` documents of every item: item_id, rank, doc_id, score (above 0).

    Statistics are of all documents with a word. Null texts have no words; repeated rows are
    documents (and items) of their own, null ids come last among equal scores; other columns are
    ignored; no documents or no items give no rows. A very long text is a segment of its own.
    """
    spark, index, out = docs.sparkSession, None, None
    kind = dict(items.dtypes)["item_id"]
    for queries, alone in query_blocks(items):
        if index is None:
            index = build(docs, {t for _, own in queries for t in own} if alone else None)
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(queries)], "query int, item string")
        part = search(index, queries, best).join(F.broadcast(names), "query").select(
            F.when(F.col("item") != "", F.col("item")).cast(kind).alias("item_id"), "rank", "doc_id", "score"
        )
        out = part if out is None else out.unionByName(part)
    return out


ORACLE = r"""
WITH terms AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
sizes AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY rid),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
postings AS (SELECT rid, term, count(*) AS tf FROM terms SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, whole GROUP BY term, docs),
impacts AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))) AS gain
  FROM postings JOIN sizes USING (rid) JOIN weights USING (term), whole),
scored AS (SELECT item_id, rid, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY ALL HAVING sum(gain) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, rid) AS INT) AS rank, doc_id, score
FROM scored
QUALIFY rank <= 50
"""
