from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm.conftest import AWKWARD, prose
from tillwise.llm import suffix_dedup as sd
from tillwise.llm.common import documents


def brute(rows):
    seen: dict[bytes, list] = {}
    texts = [(t or "").encode() for _, t in rows]
    for i, t in enumerate(texts):
        for p in range(len(t) - sd.LENGTH + 1):
            seen.setdefault(t[p : p + sd.LENGTH], []).append((i, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p : p + sd.LENGTH] = True
    out = []
    for (doc, _), t, g in zip(rows, texts, gone, strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~g])
        out.append((doc is None, doc, len(t), int(g.sum()), len(sd.runs(g)), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus(seed):
    draw = random.Random(seed)
    passages = [prose(1000 + i, n) for i, n in enumerate((20, 30, 33, 36, 60, 200))]
    rows = []
    for i in range(40):
        text = prose(seed * 100 + i, draw.randint(5, 120))
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            a = draw.randint(0, 20)
            p = p[a : len(p) - draw.randint(0, 20)]
            at = draw.randint(0, len(text))
            text = text[:at] + p + text[at:]
        rows.append((i, text))
    rows += [(50, "abc " * 200), (51, "abc " * 90), (52, "x" * 450), (53, "x" * 200), (54, "y" * 201), (55, rows[0][1]), (56, rows[1][1] + "!")]
    return rows + AWKWARD


@pytest.mark.parametrize("group_rows", [sd.GROUP_ROWS, 1])
def test_brute_force(frame, monkeypatch, group_rows):
    monkeypatch.setattr(sd, "GROUP_ROWS", group_rows)
    rows = corpus(3)
    found = sd.stretches.__defaults__
    sd.stretches.__defaults__ = (group_rows,)
    try:
        assert got(sd.removals(frame(rows))) == brute(rows)
    finally:
        sd.stretches.__defaults__ = found


def test_deep_shallow_sorts():
    draw = np.random.default_rng(4)
    for shallow in (0, 2, 8):
        texts = draw.integers(0, 2, (300, 24)).astype(np.int16)
        texts[100:150] = texts[100]
        texts[150:200, :20] = texts[150, :20]
        group = draw.integers(0, 5, 300)
        order, prefix = sd.deep_shallow(texts, group, shallow)
        keys = [(group[i], *texts[i]) for i in order]
        assert keys == sorted(keys)
        for k in range(1, 300):
            a, b = order[k - 1], order[k]
            differs = np.flatnonzero(texts[a] != texts[b])
            want = -1 if group[a] != group[b] else (differs[0] if len(differs) else 24)
            assert prefix[k] == want


def test_whole_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    assert got(sd.removals(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_documents_keep_their_columns(frame):
    both = prose(1, 80)
    docs = frame([(1, both + " one own end " + prose(2, 60)), (2, both), (3, prose(3, 50)), (4, None), (5, "")])
    out = {r.doc_id: r for r in sd.without_repeats(docs).collect()}
    assert set(out) == {1, 3, 4, 5} and sd.without_repeats(docs).columns == docs.columns
    assert "one own end" in out[1].text and out[1].n_chars == len(out[1].text) < len(both)
    assert sd.without_repeats(frame([])).count() == 0 and sd.removals(frame([])).count() == 0
