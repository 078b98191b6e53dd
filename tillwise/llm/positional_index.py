"""An inverted index with positions, dealt by documents.

Documents are taken in segments of bounded size. A segment holds, for each of its terms, one
row with the places of all occurrences, so the index is written without a shuffle and a reader
needs the rows of the terms it asks for only. A place counts words through the whole segment
and leaves one place free before each document, so no run of places crosses documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import encoded, sliced, steps
from tillwise.staging import stage

#: Bytes of text in a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 1 << 23
#: Bytes of query text that are broadcast at a time; a longer query goes alone.
BLOCK_BYTES = 1 << 22

#: Letters a-z, digits and everything beyond ASCII make words; A-Z count as a-z.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

INDEX = "segment long, term binary, n long, docs long, places binary, ids array<long>, sizes array<long>"


def words(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def build(docs: DataFrame, only: set[bytes] | None = None, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The staged index of ``doc_id, text``; null text has no words.

    Rows with a term: its occurrences ``n``, the documents ``docs`` that hold it, and ``places``
    (differences, 32 bits each). One row without a term for each segment: the ``ids`` of
    its documents and their ``sizes`` in words. ``only`` leaves other terms' rows out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(only)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in steps(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), segment_bytes):
                yield from indexed(batch.column(0)[lo:hi], batch.column(1)[lo:hi], segment, shared.value)
                segment += 1

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return stage(rows.mapInArrow(index, INDEX), "positional-index")


def indexed(ids: pa.Array, texts: pa.Array, segment: int, only: set[bytes] | None) -> Iterator[pa.RecordBatch]:
    """The index rows of one segment."""
    split = [words(t) for part in sliced([pa.RecordBatch.from_arrays([texts], ["text"])]) for t in encoded(part.column(0))]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    doc = np.repeat(np.arange(len(split)), sizes)
    coded = pa.array(chain.from_iterable(split), pa.binary(), size=int(sizes.sum())).dictionary_encode()
    del split
    terms, code = coded.dictionary, coded.indices.to_numpy()
    if only is not None:
        wanted = np.array([t in only for t in terms.to_pylist()], dtype=bool)
        used = np.flatnonzero(wanted[code]) if len(terms) else np.zeros(0, np.int64)
    else:
        used = np.arange(len(code))
    used = used[np.argsort(code[used], kind="stable")]
    code, doc, place = code[used], doc[used], (used + doc[used] + 1).astype(np.int32)
    first = np.flatnonzero(np.diff(code, prepend=-1))
    step = np.diff(place, prepend=np.int32(0)).astype("<i4")
    step[first] = place[first]
    other = (np.diff(doc, prepend=-1) != 0) | (np.diff(code, prepend=-1) != 0)
    held = np.add.reduceat(other, first, dtype=np.int64) if len(first) else first
    ends = np.append(first[1:], len(code)) if len(first) else first
    offsets = np.append(first, len(code)).astype(np.int32) * 4
    count = len(first)
    blobs = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(step.tobytes())])
    none = pa.nulls(count, pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(count, segment)), terms.take(pa.array(code[first])), pa.array(ends - first), pa.array(held), blobs, none, none],
        names=["segment", "term", "n", "docs", "places", "ids", "sizes"],
    )
    members = [[segment], [None], [int(sizes.sum())], [int((sizes > 0).sum())], [None], [ids.to_pylist()], [sizes.tolist()]]
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays(
        [pa.array(m, k) for m, k in zip(members, kinds, strict=True)], names=["segment", "term", "n", "docs", "places", "ids", "sizes"]
    )


@dataclass
class Segment:
    """One segment as a task sees it; ``start`` is the place of each document's first word."""

    ids: list[int | None]
    sizes: np.ndarray
    start: np.ndarray
    places: dict[bytes, np.ndarray]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, places, side="right") - 1


def loaded(rows: pa.Table) -> Segment:
    ids, sizes, places = [], np.zeros(0, np.int64), {}
    columns = (rows.column(c).to_pylist() for c in ("term", "places", "ids", "sizes"))
    for term, blob, members, counts in zip(*columns, strict=True):
        if term is None:
            ids, sizes = members, np.array(counts, dtype=np.int64)
        else:
            places[term] = np.cumsum(np.frombuffer(blob, "<i4"), dtype=np.int64)
    return Segment(ids, sizes, np.cumsum(sizes + 1) - sizes, places)


def asked(index: DataFrame, terms: set[bytes]) -> DataFrame:
    """The index rows of these terms (bounded by a block of queries) and every segment's members."""
    wanted = index.sparkSession.createDataFrame([(t,) for t in sorted(terms)], "term binary")
    found = index.filter("term is not null").join(F.broadcast(wanted), "term", "left_semi")
    return found.unionByName(index.filter("term is null"))


def query_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list[tuple[str, list[bytes]]], bool]]:
    """(id as text, words) of the queries, in blocks of bounded size, and if the block is the only one.

    Null ids count as empty text; rows of one id in a block are queries of their own.
    """
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    for block in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield [(r.item, words(r.text.encode())) for r in part.collect()], blocks == 1
