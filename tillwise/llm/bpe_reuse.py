"""BPE encoding and decoding with chunks that documents share encoded once.

A rolling hash cuts each text into content-defined chunks, so equal passages give equal
chunks wherever they stand. Chunks met more than once are encoded by one row of theirs; every
text then takes those ids, encodes its other chunks itself, and repairs each chunk join by
encoding the text around it again until the new tokens agree with both sides.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.bpe import VOCABULARY, Encoder, shared_encoder, special_tokens
from tillwise.llm.common import bitmap, gear_hash, gear_table, sliced, split_by
from tillwise.staging import stage

#: Chunk sizes in bytes: none but the last is shorter, one in so many positions ends a chunk
#: beyond that, and none is longer.
SHORTEST, MEAN, LONGEST = 256, 1024, 8192
_GEAR_SEED = 2
#: Where a non-space meets an ASCII space, a token always ends, whatever stands around it.
_SURE = re.compile(r"(?<=\S)(?=[ \t\n\r])")


def chunks(text: str, special: tuple[str, ...], table: np.ndarray) -> list[str]:
    """Cut a text at rolling-hash boundaries; a special token's string is a chunk of its own."""
    out: list[str] = []
    parts = re.split("(" + "|".join(map(re.escape, special)) + ")", text) if any(s in text for s in special) else [text]
    for part in parts:
        if part in special:
            out.append(part)
            continue
        raw = part.encode()
        data = np.frombuffer(raw, np.uint8)
        h = gear_hash(data, table)
        # A cut never splits a character.
        ends = np.flatnonzero((h[:-1] & np.uint32(MEAN - 1) == 0) & (data[1:] & 0xC0 != 0x80)) + 1 if len(raw) > SHORTEST else []
        start = 0
        for end in [*(ends.tolist() if len(ends) else []), len(raw)]:
            while end - start > LONGEST:
                cut = start + LONGEST
                while data[cut] & 0xC0 == 0x80:
                    cut -= 1
                out.append(raw[start:cut].decode())
                start = cut
            if end - start >= SHORTEST or end == len(raw) > start:
                out.append(raw[start:end].decode())
                start = end
    return out


def joined(encoder: Encoder, left_text: str, left: np.ndarray, text: str, ids: np.ndarray) -> np.ndarray:
    """Ids of ``left_text + text`` from the ids of both, ``left_text`` being all that came before.

    The window around the join reaches from a sure boundary on the left to one on the right.
    It is encoded again, and it widens until token ends of either side stand at its borders.
    """
    back, ahead = 64, 64
    while True:
        tail, head = left_text[-back:], text[:ahead]
        lo = 0 if back >= len(left_text) else next((m.start() for m in _SURE.finditer(tail)), None)
        hi = len(text) if ahead >= len(text) else max((m.start() for m in _SURE.finditer(head)), default=None)
        if lo is not None and hi is not None:
            keep = _tokens_for(encoder, left[::-1], len(tail[lo:].encode()))
            skip = _tokens_for(encoder, ids, len(text[:hi].encode()))
            if keep is not None and skip is not None:
                window = encoder.encode(tail[lo:] + text[:hi])
                return np.concatenate([left[: len(left) - keep], window, ids[skip:]])
        if back >= len(left_text) and ahead >= len(text):
            return encoder.encode(left_text + text)
        back, ahead = back * 4, ahead * 4


def _tokens_for(encoder: Encoder, ids: np.ndarray, n_bytes: int) -> int | None:
    """How many leading tokens cover exactly ``n_bytes``; none if a token crosses that border."""
    if n_bytes == 0:
        return 0
    ends = np.cumsum(encoder.token_lengths[ids[:n_bytes]])
    at = int(np.searchsorted(ends, n_bytes))
    return at + 1 if at < len(ends) and ends[at] == n_bytes else None


def assembled(encoder: Encoder, parts: list[str], known: dict[int, np.ndarray]) -> np.ndarray:
    """Ids of a text from its chunks; ``known`` has the ids of those encoded elsewhere."""
    whole: list[np.ndarray] = []
    text, ids = "", np.empty(0, np.uint32)
    for seq, part in enumerate(parts):
        own = known.get(seq)
        if part in encoder.special:  # nothing joins across a special token
            whole += [ids, np.array([encoder.special[part]], np.uint32)]
            text, ids = "", np.empty(0, np.uint32)
            continue
        own = encoder.encode(part) if own is None else own
        if text and not (text[-1].isspace() is False and part[0] in " \t\n\r"):
            ids = joined(encoder, text, ids, part, own)
        else:
            ids = np.concatenate([ids, own])
        text = text + part
        if len(text) > 4 * LONGEST and (cut := _settled(text)):  # what lies far behind a join is final
            keep = _tokens_for(encoder, ids[::-1], len(text[cut:].encode()))
            if keep is not None and keep < len(ids):
                whole.append(ids[: len(ids) - keep])
                ids, text = ids[len(ids) - keep :], text[cut:]
    return np.concatenate([*whole, ids])


def _settled(text: str) -> int:
    """A sure boundary about a chunk before the end, or 0."""
    return next((LONGEST + m.start() for m in _SURE.finditer(text[LONGEST:-LONGEST])), 0)


def _result(encoder: Encoder, ids: np.ndarray) -> tuple[int, str, str]:
    return (
        len(ids),
        hashlib.sha256(encoder.decimal_list(ids)).hexdigest(),
        hashlib.sha256(encoder.decode(ids)).hexdigest(),
    )


def chunk_table(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per chunk: doc_id, digest of its text, place, and the chunk's own digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, table = tuple(special_tokens(vocabulary)), gear_table(_GEAR_SEED)
        for batch in sliced(batches):
            ids, digests, places, keys = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                parts = chunks(text, special, table)
                own = hashlib.md5(text.encode(), usedforsecurity=False).digest()
                ids += [doc] * len(parts)
                digests += [own] * len(parts)
                places += range(len(parts))
                keys += [xxhash.xxh3_128_digest(p.encode()) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(places, pa.int32()), pa.array(keys, pa.binary())],
                names=["doc_id", "digest", "place", "key"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, digest binary, place int, key binary")


def with_digest(docs: DataFrame) -> DataFrame:
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return docs.select(F.col("doc_id").cast("long"), "text", digest.alias("digest"))


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Encode and decode every ``doc_id, text``.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, n_chunks, n_reused, and with
    ``with_ids`` the ids and the decoded text. Null text counts as empty; repeated rows give
    repeated results; other columns are ignored; an empty table gives no rows.
    """
    places = (
        chunk_table(docs, vocabulary)
        .groupBy("digest", "place", "key")
        .agg(F.count("*").alias("n"), F.min(F.coalesce("doc_id", F.lit(-1))).alias("doc"))
    )
    places = stage(places, "bpe-places")
    common = places.groupBy("key").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "digest", "place")).alias("one")).filter("n > 1")
    common = stage(common.select("key", "one.doc", "one.digest", "one.place"), "bpe-common")

    # One row of each shared chunk encodes it.
    sources = common.groupBy("doc", "digest").agg(F.collect_list(F.struct("place", "key")).alias("wanted"))
    by_text = with_digest(docs).withColumn("doc", F.coalesce("doc_id", F.lit(-1)))
    near, _ = split_by(by_text, bitmap(common, "doc", "digest"), "doc", "digest")

    def encode_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = shared_encoder(vocabulary), gear_table(_GEAR_SEED)
        special = tuple(encoder.special)
        for batch in sliced(batches):
            keys, ids = [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = chunks(text, special, table)
                for w in wanted:
                    keys.append(w["key"])
                    ids.append(encoder.encode(parts[w["place"]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.binary())], names=["key", "ids"])

    shared = (
        near.join(sources, ["doc", "digest"])
        .select("text", "wanted")
        .mapInArrow(encode_shared, "key binary, ids binary")
        .groupBy("key")
        .agg(F.first("ids").alias("ids"))  # repeated rows encode alike
    )
    shared = stage(shared, "bpe-shared")
    # A table of its own, so that the rows of a text with very many copies can be split in the join.
    reused = places.join(shared, "key").groupBy("digest").agg(F.collect_list(F.struct("place", "ids")).alias("reused"))
    reused = stage(reused, "bpe-reused")

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_chunks long, n_reused long"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def finish(batches: Iterator[pa.RecordBatch], reuse: bool) -> Iterator[pa.RecordBatch]:
        encoder, table = shared_encoder(vocabulary), gear_table(_GEAR_SEED)
        special = tuple(encoder.special)
        for batch in sliced(batches):
            out = []
            known = batch.column(2).to_pylist() if reuse else [None] * batch.num_rows
            for doc, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), known, strict=True):
                parts = chunks(text or "", special, table)
                ready = {k["place"]: np.frombuffer(k["ids"], np.uint32) for k in own or ()}
                ids = assembled(encoder, parts, ready)
                row = (doc, *_result(encoder, ids), len(parts), len(ready))
                out.append(row + ((ids.tolist(), encoder.decode(ids).decode()) if with_ids else ()))
            names = [f.strip().split(" ")[0] for f in schema.split(",")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string()]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    some, none = split_by(
        with_digest(docs), bitmap(reused.select("digest"), "digest"), "digest", rest=(lambda b: finish(b, reuse=False), schema)
    )
    some = some.join(reused, "digest", "left").select("doc_id", "text", "reused")
    return some.mapInArrow(lambda b: finish(b, reuse=True), schema).unionByName(none)
