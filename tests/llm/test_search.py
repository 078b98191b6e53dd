"""Ranked search, decontamination and the filter audit against plain loops."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from tests.llm.conftest import AWKWARD, prose
from tillwise.llm import filter_audit as fa
from tillwise.llm import nra_search as ns
from tillwise.llm import phrase_index as ph
from tillwise.llm import positional_index as pi

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PASSAGE = prose(7, 30, 80)


def words(text):
    return [w.lower() if w.isascii() else w for w in WORD.findall((text or "").translate(LOWER))]


def corpus():
    rows = [(i, prose(i, 40 + 17 * (i % 9), 60)) for i in range(60)]
    rows += [(200 + i, prose(300 + i, 50, 60) + " " + PASSAGE + "! " + prose(400 + i, 20, 60)) for i in range(5)]
    rows += [(300 + i, rows[3][1]) for i in range(70)]  # more copies than places in a ranking
    rows += [(400, PASSAGE.upper()), (401, " ".join(PASSAGE.split()[:9])), (402, "ÀB àb Ab ab"), (403, prose(9, 60_000, 60) + " " + PASSAGE)]
    return rows + AWKWARD


ITEMS = [
    (1, PASSAGE), (2, prose(3, 25, 60)), (3, "Ab àb"), (4, None), (5, ""), (6, "nowhere ever seen"), (10, PASSAGE), (7, "x"),
    (8, " ".join(prose(1, 12, 60).split()[:4])), (9, prose(5, 300, 60)),
]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, segment int")


def ranking(rows, queries, best):
    split = [(d, Counter(words(t))) for d, t in rows]
    n = sum(1 for _, c in split if c)
    length = sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in queries:
        scores = []
        for d, c in split:
            m = 50 + (50 * sum(c.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(words(text)) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, k, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def test_ranking(frame, items, monkeypatch):
    rows = corpus()
    want = ranking(rows, ITEMS, 50)
    assert Counter(i for i, *_ in want)[2] == 50
    found = ns.rank(frame(rows), items)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str) == want
    # Small segments and blocks of queries change nothing.
    monkeypatch.setattr(ns, "query_blocks", lambda x: pi.query_blocks(x, 300))
    monkeypatch.setattr(ns, "build", lambda d, only=None: pi.build(d, only, 2000))
    assert len(list(pi.query_blocks(items, 300))) > 3
    found = ns.rank(frame(rows), items, 7)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str) == ranking(rows, ITEMS, 7)
    assert ns.rank(frame([]), items).count() == 0 and ns.rank(frame(rows), items.limit(0)).count() == 0


def test_reads_resolve_the_best():
    """All documents as good as the last place are returned, with their whole scores."""
    draw = np.random.default_rng(3)
    sizes = draw.integers(20, 400, 3000)
    segment = pi.Segment(list(range(3000)), sizes, np.cumsum(sizes + 1) - sizes, {})
    for k in range(12):
        segment.places[b"%d" % k] = np.sort(draw.choice(int(sizes.sum()), 40 << k // 2, replace=False))
    lists = ns.Lists(segment, 3000, int(sizes.sum()))
    terms = [(b"%d" % k, 5000 - 300 * k) for k in range(12)]
    score = np.zeros(3000, dtype=np.int64)
    for t, w in terms:
        docs, impact = lists.of(t)
        assert (np.diff(impact) <= 0).all()
        score[docs] += w * impact
    for best, block in ((1, 8), (50, 64), (50, 1), (2999, 64), (5000, 64)):
        docs, exact = ns.read(lists, terms, best, block)
        floor = max(1, int(np.sort(score)[-best])) if best < 3000 else 1
        assert (exact == score[docs]).all() and set(np.flatnonzero(score >= floor)) == set(docs.tolist())


def contaminated(rows, tests, size, slop=0):
    out = []
    for d, t in rows:
        own, hit, ids = words(t), set(), set()
        for item, text in tests:
            test = words(text)
            for i in range(max(len(test) - size, 0) + 1 if test else 0):
                w = test[i : i + size]
                for s in range(len(own) - len(w) + 1):
                    if own[s : s + len(w)] == w:
                        hit |= set(range(s, s + len(w)))
                        ids.add("" if item is None else str(item))
        out.append((d, len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination(frame, items, monkeypatch):
    rows = [r for r in corpus() if r[0] != 403] + [(403, prose(9, 3000, 60) + " " + PASSAGE)]
    tests = [t for t in ITEMS if t[0] != 9]
    items = items.filter("item_id <> 9")
    want = contaminated(rows, tests, 10)
    assert sum(w[5] for w in want) > 10
    assert sorted(map(tuple, ph.decontaminate(frame(rows), items).collect()), key=str) == want
    monkeypatch.setattr(ph, "query_blocks", lambda x: pi.query_blocks(x, 300))
    monkeypatch.setattr(ph, "build", lambda d: pi.build(d, None, 2000))
    assert sorted(map(tuple, ph.decontaminate(frame(rows), items).collect()), key=str) == want
    assert sorted(map(tuple, ph.decontaminate(frame(rows), items.limit(0)).collect()), key=str) == contaminated(rows, [], 10)
    assert ph.decontaminate(frame([]), items).count() == 0


def test_proximity(spark, frame):
    rows = [(1, "a x b y c"), (2, "a b c"), (3, "c b a"), (4, "a x x b c"), (5, "a b"), (6, "c"), (7, "b a a b b c")]
    tests = spark.createDataFrame([("t", "A b, c")], "item_id string, text string")
    index = pi.build(frame(rows).coalesce(1))
    got = {slop: {r.doc_id: [tuple(s) for s in r.spans] for r in ph.matches(index, tests, slop=slop).collect() if r.spans} for slop in (0, 1, 2)}
    assert got[0] == {2: [("t", 0, 3)]}
    assert got[1] == {2: [("t", 0, 3)], 7: [("t", 2, 6)]}
    assert got[2] == {1: [("t", 0, 5)], 2: [("t", 0, 3)], 4: [("t", 0, 5)], 7: [("t", 2, 6)]}


def audited(rows, labels):
    split = re.compile("[^\x20\x09-\x0d]+")
    docs, out = [], []
    for d, t, lang in rows:
        t = t or ""
        own = split.findall(t)
        fails = "A" * (len(own) < 200) + "B" * (100 * len(set(own)) < 50 * len(own)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        fails += "E" * any(o is not None and d is not None and o < d and (x or "") == t for o, x, _ in rows)
        docs.append((lang or "", fails, any(i == d and q == 1 for i, q, _ in labels), any(i == d and x == 1 for i, _, x in labels)))
    for part in {p for p, *_ in docs}:
        own, removed = [d for d in docs if d[0] == part], {}
        for order in permutations("ABCDE"):
            left, before = own, set()
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed["".join(order), step] = [len(left), len(gone), sum(f in d[1] and bool(before & set(d[1])) for d in own), sum(d[1] == f for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)]
                before.add(f)
        total = Counter()
        for (order, step), v in removed.items():
            total[order[step - 1]] += v[1]
        out += [(part, order, step, *v, total[order[step - 1]]) for (order, step), v in removed.items()]
    return sorted(out)


def test_filter_audit(spark, frame):
    rows = [(i, prose(i, 150 + 20 * (i % 7), 500 if i % 3 else 20) + ("#" if i % 4 == 0 else "") + ("ABC" * 40 if i % 5 == 0 else ""), ["aa", "bb", None][i % 3]) for i in range(40)]
    rows += [(90 + i, rows[i % 3][1], "aa") for i in range(9)] + [(*r, "bb") for r in AWKWARD] + [(500, None, None), (501, "", ""), (502, prose(1, 30_000), "cc")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 100, 2)] + [(4, 1, 0), (4, None, 1), (None, 1, 1)]
    labels = [(a, b, None if c is None else int(c)) for a, b, c in labels]
    found = fa.audit_documents(frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    known = [x for x in labels if x[0] is not None]
    assert sorted(map(tuple, found)) == audited(rows, known)
    assert fa.audit_documents(frame([]), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_removal_steps():
    orders, step = fa.removal_steps(np.arange(8), 3)
    for m in range(8):
        for o, s in zip(orders.tolist(), step[m].tolist(), strict=True):
            assert s == next((k for k, f in enumerate(o, 1) if m >> f & 1), 4)
