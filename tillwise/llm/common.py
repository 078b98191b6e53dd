"""Small pieces the text operators share: reading, slicing batches, hashing, pre-filters."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step looks at; a longer text is a step of its own.
STEP_BYTES = 1 << 18
#: Words are runs of anything but these ASCII separators.
SEPARATORS = b" \t\n\x0b\x0c\r"
#: Bits of a pre-filter bitmap (4 MiB). A fuller bitmap only lets more rows through.
BITMAP_BITS = 1 << 25


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free(df: DataFrame, name: str) -> str:
    """A helper column's name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC of its id's digits (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def steps(sizes: list[int], most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items of about ``most`` bytes together, one item at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a well-known hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gear_table(seed: int) -> np.ndarray:
    """256 fixed random 64-bit values, one for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gear_hash(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Gear hash of the last 32 bytes at each position, as 32 bits, by doubling the window."""
    h = (table >> np.uint64(32)).astype(np.uint32)[data]
    for shift in (1, 2, 4, 8, 16):
        if len(h) > shift:
            h[shift:] += h[:-shift] << np.uint32(shift)
    return h


def bitmap(keys: DataFrame, *columns: str) -> np.ndarray:
    """A bitmap of fixed size over the hashes of key rows, gathered as at most BITMAP_BITS / 64 words.

    It only spares later shuffles rows that cannot match; the join behind it stays exact.
    """
    slot = F.pmod(F.xxhash64(*columns), F.lit(BITMAP_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = keys.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    out[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint8)


Batches = Iterator[pa.RecordBatch]


def released() -> None:
    """Give freed memory back, so that a Python worker which waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, and its freed memory given back at the end of the task."""

    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            released()

    return whole


def sliced(batches: Batches, rows: int = 512) -> Batches:
    """Smaller batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def split_by(
    df: DataFrame, bits: np.ndarray, *columns: str, rest: tuple[Callable[[Batches], Batches], str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be in the bitmap, and rows whose key is certainly not.

    ``rest`` is a function with its schema that the latter go through in the same Python worker.
    """
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def test(batches: Iterator[pa.RecordBatch], want: bool) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            slot = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            hit = (words[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(hit == want))

    slotted = df.withColumn(free(df, "slot"), F.pmod(F.xxhash64(*columns), F.lit(BITMAP_BITS)))
    further, schema = rest or (lambda b: b, df.schema)
    return (
        slotted.mapInArrow(tidy(lambda b: test(b, True)), df.schema),
        slotted.mapInArrow(tidy(lambda b: further(test(b, False))), schema),
    )
