from __future__ import annotations

import zlib

import numpy as np

from tests.llm.conftest import AWKWARD, prose
from tillwise.llm import stock_packing as sp
from tillwise.llm.bpe import Encoder
from tillwise.llm.common import documents


def check(rows, packed, most_padding):
    encoder = Encoder()
    want = sorted(len(encoder.encode(t or "")) + 1 for _, t in rows)
    assert sorted(p.doc_tokens for p in packed if p.start == 0) == want
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(np.append(encoder.encode(t or ""), 1).astype("<u4"))
    for p in packed:
        assert any(len(ids) == p.doc_tokens and zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for ids in texts[p.doc_id])
    assert sum(p.length for p in packed) == sum(want)
    sequences = {}
    for p in packed:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    stored = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sp.SEQUENCE
        stored += int(sp.padded_size(at))
    assert stored <= sum(want) * (1 + most_padding)


def test_awkward_rows(frame):
    rows = [(i, prose(i, 200 + 97 * i)) for i in range(12)] + AWKWARD
    check(rows, sp.pack(frame(rows)).collect(), 0.2)
    assert sp.pack(frame([])).count() == 0


def test_whole_table(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    check([(r.doc_id, r.text) for r in docs.collect()], sp.pack(docs).collect(), 0.01)


def test_inverse():
    draw = np.random.default_rng(5)
    basis = draw.integers(1, 5, (60, 60)) * (draw.random((60, 60)) < 0.1) + np.eye(60)[draw.permutation(60)] * 9.0
    assert np.allclose(sp.inverted(basis) @ basis, np.eye(60))


def test_plan_meets_the_demand():
    draw = np.random.default_rng(3)
    for most, rows in ((40, 30), (2047, 5000), (300, 100_000)):
        lengths, demand = np.unique(draw.integers(1, most + 1, rows), return_counts=True)
        patterns, uses = sp.rounded(lengths, demand)
        assert (uses @ patterns == demand).all() and (patterns @ lengths <= sp.SEQUENCE).all()
        assert sp.padded_size(patterns @ lengths) @ uses <= lengths @ demand * 1.01 + sp.SEQUENCE


def best_stored(lengths, size):
    """Least stored length of some rests, by trying every way to part them."""
    if not lengths:
        return 0
    first, rest, best = lengths[0], lengths[1:], float("inf")
    for mask in range(1 << len(rest)):
        own = [x for i, x in enumerate(rest) if mask >> i & 1]
        if first + sum(own) <= size:
            other = [x for i, x in enumerate(rest) if not mask >> i & 1]
            best = min(best, int(sp.padded_size(first + sum(own), size)) + best_stored(other, size))
    return best


def test_plans_against_all_partitions():
    draw = np.random.default_rng(11)
    for _ in range(25):
        size = int(draw.choice([16, 24, 32]))
        rests = draw.integers(1, size, int(draw.integers(1, 9)))
        lengths, demand = np.unique(rests, return_counts=True)
        best = best_stored(rests.tolist(), size)
        solution = sp.column_generation(lengths, demand, size)
        assert solution.rounds >= 1 and np.allclose(solution.uses @ solution.patterns, demand, atol=0.05)
        stored = sp.padded_size(solution.patterns @ lengths, size)
        assert stored @ solution.uses <= best + size / 2 + 0.2  # the program is a lower bound
        patterns, uses = sp.rounded(lengths, demand, size)
        assert (uses @ patterns == demand).all() and best <= sp.padded_size(patterns @ lengths, size) @ uses <= best + 2 * size


def test_pricing_runs_and_proves_its_plan():
    draw = np.random.default_rng(7)
    for most, rows in ((2047, 200), (300, 100_000)):
        lengths, demand = np.unique(np.minimum(draw.geometric(1 / 400, rows), most), return_counts=True)
        solution = sp.column_generation(lengths, demand)
        assert solution.rounds >= 1 and solution.gap <= max(2 * sp.GAP, sp.SEQUENCE / (lengths @ demand))
    # Few rests on many lengths: the first basis is far from the end and columns come in.
    lengths, demand = np.unique(draw.integers(1, 2047, 150), return_counts=True)
    assert sp.column_generation(lengths, demand).priced > 0


def test_column_generation_reaches_the_optimum():
    # 1500 goes with 500 alone, 900 twice, and 700 fills what 1300 leaves: known best plan.
    lengths, demand = np.array([500, 700, 900, 1300, 1500]), np.array([40, 30, 20, 30, 40])
    solution = sp.column_generation(lengths, demand)
    assert np.allclose(solution.uses @ solution.patterns, demand)
    assert sp.padded_size(solution.patterns @ lengths) @ solution.uses <= (40 + 30 + 10) * 2048 + 1e-6
    best, last = sp.priced(np.array([1.0, 5.0]), np.array([3, 7]), 17)
    assert best[17] == 11 and sp.pattern(last, np.array([3, 7]), 17).tolist() == [1, 2]
