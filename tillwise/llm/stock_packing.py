"""Packing by cutting-stock column generation.

Every document becomes blocks of a full sequence and one rest. Rests of each length are
counted over all documents; a linear program over patterns (how many rests of which
lengths share a sequence) is solved by column generation, with a knapsack over the exact
fill pricing new columns. The rounded patterns take documents by their rank among rests
of the same length. Only the histogram (fewer than ``size`` numbers) and the patterns reach
the driver, whatever the number of documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.bpe import VOCABULARY, shared_encoder
from tillwise.llm.common import tidy
from tillwise.staging import stage

SEQUENCE = 2048
END = 1
#: Column generation ends when the plan is proven within this share of the least stored length, or
#: within half a sequence, which no whole number of sequences shows.
GAP = 5e-4
#: Patterns brought in by a round at most, exchanges until the inverse is worked out afresh, and the
#: largest move of a use of a pattern against circles.
COLUMNS, AFRESH, SHIFT = 4, 200, 1e-3
#: It also ends when so many rounds have saved less than a tenth of ``GAP``; the solution tells what is proven then.
STALL = 30
#: Rests by which the plan of a basis may miss the demand before the basis counts as ill.
EXACT = 1e-4
#: Parts in which rests of one length are ranked, so that no length meets in one task.
RANK_PARTS = 1024

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, doc_key long"


def padded_size(fill: int | np.ndarray, size: int = SEQUENCE) -> np.ndarray:
    """Stored length of a sequence with ``fill`` tokens: a power of two needs no padding."""
    fill = np.asarray(fill)
    return np.where((fill & (fill - 1)) == 0, fill, size)


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, size: int = SEQUENCE) -> DataFrame:
    """Tokenise ``doc_id, text`` once and cut each document into full blocks and one rest.

    Null text counts as empty: one piece that holds the end token alone. ``doc_key`` is a hash
    of id and text that spreads equal lengths over parts.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc, text, key in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.append(encoder.encode(text or ""), np.uint32(END)).astype("<u4")
                for at in range(0, len(ids), size):
                    part = ids[at : at + size]
                    rows.append((doc, at, len(part), zlib.crc32(part.tobytes()), len(ids), key))
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "doc_key")
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text"))
    return keyed.mapInArrow(tidy(cut), PIECES)


def priced(value: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack over the exact fill: the best total of dual values, and the last item taken."""
    best = np.full(size + 1, -np.inf)
    best[0], last = 0.0, np.zeros(size + 1, dtype=np.int64)
    ends = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for fill in range(int(lengths[0]), size + 1):
        total = best[fill - lengths[: ends[fill]]] + value[: ends[fill]]
        k = int(total.argmax())
        best[fill], last[fill] = total[k], k
    return best, last


def pattern(last: np.ndarray, lengths: np.ndarray, fill: int) -> np.ndarray:
    out = np.zeros(len(lengths))
    while fill:
        k = last[fill]
        out[k] += 1
        fill -= int(lengths[k])
    return out


def filled(lengths: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """A sequence of the longest rest there is and others that leave the least padding.

    Reachable fills are the bits of an integer; ways back are kept for each length used.
    """
    out = np.zeros(len(lengths), dtype=np.int64)
    on = np.flatnonzero(left > 0)
    longest = int(on[-1])
    out[longest], start = 1, int(lengths[longest])
    limit, reach, ways = (1 << (size + 1)) - 1, 1 << start, []
    for k in on[::-1].tolist():
        length = int(lengths[k])
        n = min(int(np.ceil(left[k])) - (k == longest), (size - start) // length)
        for _ in range(n):
            wider = (reach | reach << length) & limit
            if wider == reach:
                break
            ways.append((k, length, reach))
            reach = wider
        if reach >> size & 1:
            break
    fill = size if reach >> size & 1 else next(
        (p for e in range(size.bit_length() - 1, -1, -1) if (p := 1 << e) >= start and reach >> p & 1), reach.bit_length() - 1
    )
    for k, length, before in reversed(ways):
        if not before >> fill & 1:
            out[k] += 1
            fill -= length
    return out


def exhausted(lengths: np.ndarray, demand: np.ndarray, size: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Fill sequences greedily, each pattern as often as the rests allow (whole times or not).

    Without whole times each pattern uses up a length, so the patterns are a basis of the
    linear program, with a pattern of no use for a length that ended beside another.
    """
    left, patterns, uses = demand.astype(np.int64 if whole else float).copy(), [], []
    while (left > 0).any():
        found = filled(lengths, left, size)
        taken = found > 0
        n = (left[taken] // found[taken]).min() if whole else (left[taken] / found[taken]).min()
        left = left - n * found
        patterns.append(found)
        uses.append(n)
        if not whole:
            ended = np.flatnonzero(taken & (left <= 1e-9))
            left[ended] = 0
            for k in ended[1:]:
                patterns.append(np.eye(1, len(lengths), k, dtype=np.int64)[0] * (size // lengths[k]))
                uses.append(0)
    return np.array(patterns, dtype=np.int64).reshape(-1, len(lengths)), np.array(uses)


def inverted(basis: np.ndarray) -> np.ndarray:
    """Inverse by one pivot for each column, which are sparse.

    Not by LAPACK: its threads can stand still in a driver that was forked from.
    """
    n = len(basis)
    inverse, free, place = np.eye(n), np.ones(n, dtype=bool), np.zeros(n, dtype=np.int64)
    for k in range(n):
        on = np.flatnonzero(basis[:, k])
        move = (inverse[:, on] * basis[on, k]).sum(axis=1)
        out = int(np.where(free, np.abs(move), -1).argmax())
        row, rows = inverse[out] / move[out], np.flatnonzero(move)
        inverse[rows] -= move[rows, None] * row
        inverse[out], free[out], place[k] = row, False, out
    return inverse[place]


@dataclass
class Solution:
    """Patterns (rows), how often each is used, and how the linear program got there."""

    patterns: np.ndarray
    uses: np.ndarray
    rounds: int
    priced: int
    gap: float


def column_generation(lengths: np.ndarray, demand: np.ndarray, size: int = SEQUENCE) -> Solution:
    """The linear program over patterns, by a revised simplex with one row for each length.

    It begins with a basis of filled sequences. Each round prices all fills by the knapsack, in the first
    with the lengths as dual values, which no pattern violates, so that the tokens are a bound;
    then with those of the basis, bringing in the patterns of least reduced cost. It ends when the dual
    values (scaled until no pattern violates them) prove the plan within ``GAP`` or half a sequence,
    when no pattern prices out, or when rounds bring next to nothing; ``gap`` is what is proven in any
    case. The demand is moved by tiny amounts, as many equal counts would let the simplex turn in
    circles; the result is for the demand as it is. A basis that cannot be inverted
    well is not exchanged further: the last plan that meets the demand stands.
    """
    first, first_used = exhausted(lengths, demand, size, whole=False)
    cost = padded_size(first @ lengths, size).astype(float)
    fills = np.arange(1, size + 1)
    price = padded_size(fills, size).astype(float)
    best, _ = priced(lengths.astype(float), lengths, size)
    bound = float(lengths @ demand) / max(1.0, (best[1:] / price).max())
    rounds, priced_in, plan = 1, 0, (first, first_used.astype(float), float(cost @ first_used))

    def proven(total: float) -> bool:
        return total <= bound + max(GAP * bound, size / 2)

    basis, costs, changed = first.T.astype(float), [plan[2]], 0
    need = basis @ (first_used + np.random.default_rng(1).random(len(lengths)) * SHIFT)
    inverse = inverted(basis) if not proven(plan[2]) else basis
    used = np.maximum(np.einsum("ij,j->i", inverse, need), 0)
    fine = not proven(plan[2]) and np.abs(basis @ used - need).max() < EXACT
    while fine and not proven(plan[2]):
        rounds += 1
        dual = np.einsum("i,ij->j", cost, inverse)
        best, last = priced(dual, lengths, size)
        bound = max(bound, (dual @ demand) / max(1.0, (best[1:] / price).max()))
        before = priced_in
        for fill in fills[np.argsort(price - best[1:])[:COLUMNS]].tolist():
            column = pattern(last, lengths, fill) if np.isfinite(best[fill]) else None
            if column is None or np.einsum("i,ij->j", cost, inverse) @ column - price[fill - 1] <= 1e-6:
                continue
            move = np.einsum("ij,j->i", inverse, column)
            can = move > 1e-6
            if not can.any():
                continue
            ratio = np.where(can, used / np.where(can, move, 1), np.inf)
            out = int(ratio.argmin())
            times = ratio[out]
            used = np.maximum(used - times * move, 0)
            used[out] = times
            basis[:, out], cost[out] = column, price[fill - 1]
            row = inverse[out] / move[out]
            inverse -= np.outer(move, row)
            inverse[out] = row
            priced_in, changed = priced_in + 1, changed + 1
        costs.append(float(cost @ used))
        stalled = len(costs) > STALL and costs[-STALL - 1] - costs[-1] < GAP / 10 * bound
        done = priced_in == before or stalled or proven(costs[-1])
        if changed >= AFRESH or done:  # rounding errors add up
            inverse, changed = inverted(basis), 0
            used = np.maximum(np.einsum("ij,j->i", inverse, need), 0)
            exact = np.maximum(np.einsum("ij,j->i", inverse, demand.astype(float)), 0)
            fine = np.abs(basis @ used - need).max() < EXACT
            if fine and np.abs(basis @ exact - demand).max() < 0.5 and float(cost @ exact) < plan[2]:
                plan = np.rint(basis.T).astype(np.int64), exact, float(cost @ exact)
        if done:
            break
    return Solution(plan[0], plan[1], rounds, priced_in, plan[2] / bound - 1)


def rounded(lengths: np.ndarray, demand: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Integer pattern uses that meet the demand exactly.

    The solution is rounded down; the rests that stay (at most what each pattern holds,
    however many documents there are) fill further sequences greedily.
    """
    solution = column_generation(lengths, demand, size)
    found, whole, left = solution.patterns, np.floor(solution.uses + 1e-6).astype(np.int64), demand.copy()
    for p in np.flatnonzero(whole):
        on = np.flatnonzero(found[p])
        whole[p] = min(whole[p], int((left[on] // found[p, on]).min()))  # never more than there are
        left[on] -= whole[p] * found[p, on]
    more, times = exhausted(lengths, left, size, whole=True)
    return np.concatenate([found[whole > 0], more]), np.concatenate([whole[whole > 0], times]).astype(np.int64)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, size: int = SEQUENCE) -> DataFrame:
    """Sequences of at most ``size`` tokens for all of ``doc_id, text``.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null
    text is empty and still has its end token; repeated rows are packed each on their own; an
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    cut = stage(pieces(docs, vocabulary, size), "packing-pieces")
    counts = stage(
        cut.groupBy("length", F.pmod("doc_key", F.lit(RANK_PARTS)).alias("part")).agg(F.count("*").alias("n")),
        "packing-counts",
    )
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").toPandas()
    full = int(histogram.loc[histogram["length"] == size, "n"].sum())
    rests = histogram[histogram["length"] < size]
    lengths, demand = rests["length"].to_numpy(dtype=np.int64), rests["n"].to_numpy(dtype=np.int64)
    patterns, uses = rounded(lengths, demand, size) if len(lengths) else (np.zeros((0, 0)), np.zeros(0))

    # Rank ranges by length: pattern p's uses take ranks first .. first + uses * each - 1.
    plan, taken, sequence = [(size, 0, full, 1, 0, 0)], np.zeros(len(lengths), dtype=np.int64), full
    for p, n in zip(patterns, uses, strict=True):
        at = 0
        for k in np.flatnonzero(p).tolist():
            each = int(p[k])
            plan.append((int(lengths[k]), int(taken[k]), int(taken[k] + n * each), each, sequence, at))
            taken[k] += n * each
            at += each * int(lengths[k])
        sequence += int(n)
    columns = "p_length long, first long, beyond long, each long, p_sequence long, p_offset long"
    ranges = spark.createDataFrame(plan, columns)

    by_part = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("doc_key", "doc_id", "start")
    ranked = (
        cut.withColumn("part", F.pmod("doc_key", F.lit(RANK_PARTS)))
        .withColumn("place", F.row_number().over(within) - 1)
        .join(before, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("place"))
    )
    # At most a few rows for each length and pattern: bounded by the plan, not by the documents.
    on = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("beyond"))
    slot = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(ranges), on).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("p_sequence") + F.floor(slot / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + slot % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
