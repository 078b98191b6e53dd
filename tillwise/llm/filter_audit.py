"""Audit of how filters interact, by min-plus removal ranks.

Only which filters a document fails decides where an order of filters removes it, so documents
are counted by that pattern. A pattern is a row of the mask matrix: 0 for a filter it
fails, else infinity. An order is a row of the position matrix, its inverse permutation: the
step of each filter. Their product with minimum for sum and sum for product is the step that
removes the pattern in the order, and the counts are scattered to it as weights.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import encoded, sliced
from tillwise.staging import stage

FILTERS = "ABCDE"
#: Failure conditions of the text filters; E is by the texts of all documents.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SYMBOLS, CAPITALS = b"#$%&*|", bytes(range(65, 91))
CONTINUED = bytes(range(0x80, 0xC0))


def failed_bits(text: bytes) -> int:
    """Bits of filters A to D that a whole text fails."""
    own = text.split()  # at the six ASCII blanks
    points = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(own) < LEAST_WORDS)
        | (100 * len(set(own)) < LEAST_DISTINCT * len(own)) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: part, mask (bit k: fails filter k), good and toxic (0 or 1).

    The first document of a text passes E: the one of the smallest id, and all its rows. A null id
    passes E and is no one's first. Labels are joined by id; of several, any 1 counts.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = encoded(batch.column(1))
            columns = [
                batch.column(0), batch.column(2),
                pa.array([failed_bits(t) for t in texts], pa.int32()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "mask", "digest"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    judged = stage(rows.mapInArrow(judge, "doc_id long, part string, mask int, digest binary"), "audit-masks")
    firsts = judged.groupBy("digest").agg(F.min("doc_id").alias("first")).select(F.col("digest").alias("of"), "first")
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.coalesce(F.max(F.when(F.col("quality") == 1, 1)), F.lit(0)).alias("good"), F.coalesce(F.max(F.when(F.col("toxic") == 1, 1)), F.lit(0)).alias("toxic")
    )
    # By digest and id together, so that copies of one text do not meet in a task.
    own = judged.join(firsts, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    later = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 16).otherwise(0)
    own = own.select("doc_id", "part", F.col("mask").bitwiseOR(later).alias("mask"))
    both = own.join(marks, F.col("doc_id") == F.col("labelled"), "left")
    return both.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def removal_steps(masks: np.ndarray, filters: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of the filters (rows of filter numbers), and the step (from 1) that removes
    each mask in each order; one more than the number of filters if none does."""
    orders = np.array(list(permutations(range(filters))), dtype=np.int64).reshape(-1, filters)
    position = np.argsort(orders, axis=1) + 1  # the inverse permutation
    never = filters + 1
    mask = np.where(masks[:, None] >> np.arange(filters) & 1 == 1, 0, never)
    return orders, np.minimum((mask[:, None, :] + position[None, :, :]).min(axis=2), never)


def audit(rows: DataFrame, filters: str = FILTERS, weights: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """For every part, order of ``filters`` and step what the filters do to each other.

    ``rows`` has part, mask (bit k: fails filter k) and 0/1 ``weights``. Columns: part,
    filter_order, step; kept, removed, redundant, unique_fails, ``<weight>_lost`` for each weight, and
    shapley, the removals of the step's filter summed over all orders. A part has
    filters! x filters rows whatever the number of documents, zeros included.
    """
    names, n = ["kept", "removed", "redundant", "unique_fails", *(f"{w}_lost" for w in weights), "shapley"], len(filters)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, patterns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                masks = np.array([p["mask"] for p in patterns], dtype=np.int64)
                counts = np.array([[p[c] for c in ("n", *weights)] for p in patterns], dtype=np.int64)
                orders, step = removal_steps(masks, n)
                lost = np.zeros((len(orders), n + 2, counts.shape[1]), dtype=np.int64)
                which = np.broadcast_to(np.arange(len(orders)), step.shape)
                np.add.at(lost, (which, step), np.broadcast_to(counts[:, None, :], (*step.shape, counts.shape[1])))
                lost = lost[:, 1 : n + 1]
                fails = masks[:, None] >> np.arange(n) & 1
                failing = (counts[:, :1] * fails).sum(axis=0)
                unique = (counts[:, :1] * (fails & (fails.sum(axis=1, keepdims=True) == 1))).sum(axis=0)
                removed = lost[:, :, 0]
                shapley = np.array([removed[orders == k].sum() for k in range(n)], dtype=np.int64)
                columns = [counts[:, 0].sum() - np.cumsum(removed, axis=1), removed, failing[orders] - removed, unique[orders], *(lost[:, :, 1 + k] for k in range(len(weights))), shapley[orders]]
                labels = np.repeat(["".join(filters[k] for k in o) for o in orders.tolist()], n)
                data = [pa.array([part] * len(labels)), pa.array(labels.tolist()), pa.array(np.tile(np.arange(1, n + 1), len(orders)), pa.int32())]
                yield pa.RecordBatch.from_arrays([*data, *(pa.array(c.reshape(-1), pa.int64()) for c in columns)], names=["part", "filter_order", "step", *names])

    patterns = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.sum(w).alias(w) for w in weights))
    parts = patterns.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *weights)).alias("patterns"))  # 2^filters at most
    return parts.mapInArrow(spread, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over whole texts, parts by ``lang`` (null: empty string).

    Null text is empty: it fails A, and E after the first such document. Repeated rows count each; other
    columns are ignored; an empty table gives no rows; a very long text is one step of a task.
    """
    return audit(masked(docs, labels))


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
firsts AS (SELECT text, min(doc_id) AS first FROM doc GROUP BY text),
masks AS (
  SELECT part,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM doc JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
cells AS (SELECT part, filter_order, step, filter_order[step] AS f FROM (SELECT DISTINCT part FROM counted), orders, (SELECT unnest(range(1, 6)) AS step)),
removal AS (
  SELECT part, filter_order, fails, n, good, toxic, length(fails) = 1 AS alone,
    list_min([CASE WHEN contains(fails, filter_order[i]) THEN i ELSE 6 END for i in range(1, 6)]) AS gone
  FROM counted, orders),
done AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed,
    coalesce(sum(n) FILTER (gone < step AND contains(fails, f)), 0) AS redundant, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
    coalesce(sum(good) FILTER (gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
  FROM cells JOIN removal USING (part, filter_order) GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM done
"""
