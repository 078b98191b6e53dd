from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD, prose
from tillwise.llm import simhash_trie as st
from tillwise.llm.common import documents


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected(rows):
    prints = [slow_print(t) for _, t in rows]
    root = slow_components(prints)
    least = {}
    for (doc, _), r in zip(rows, root, strict=True):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted((d is None, d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, root, strict=True))


def got(df):
    return sorted((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_brute_force(frame):
    base = prose(1, 300)
    rows = [(i, prose(i, 60)) for i in range(20)] + [(200 + i, base.replace(" ", f" w{i} ", i % 4)) for i in range(30)]
    rows += [(300, "Ä Ö ABC"), (301, "ä ö abc"), (302, "one two"), (303, "ONE  two"), *AWKWARD]
    assert got(st.near_duplicates(frame(rows))) == expected(rows)
    assert st.near_duplicates(frame([])).count() == 0


def test_whole_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    assert got(st.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("trie_rows", [4096, 8])
def test_links_of_dense_clusters(spark, monkeypatch, trie_rows):
    monkeypatch.setattr(st, "TRIE_ROWS", trie_rows)
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(6)]
    prints = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(60):
            prints.add(c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))))
    prints = sorted(prints | {draw.getrandbits(64) for _ in range(100)})
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    linked = st.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = {r.node: r.root for r in st.components(linked).collect()}
    root = slow_components(prints)
    want = {}
    for p, r in zip(signed, root, strict=True):
        want.setdefault(r, set()).add(p)
    have = {}
    for p in signed:
        have.setdefault(found.get(p, p), set()).add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def hash_of(text):
    return "" if text is None else hashlib.md5(text.encode()).hexdigest()


def one_of_each(rows):
    """Least (doc_id, MD5) of each component by brute force."""
    root, groups = slow_components([slow_print(t) for _, t in rows]), {}
    for (d, t), r in zip(rows, root, strict=True):
        groups.setdefault(r, []).append((d is None, d or 0, hash_of(t)))
    return sorted(min(g) for g in groups.values())


def test_one_document_stays(frame):
    text = prose(1, 200)
    rows = [(5, text), (3, text), (9, text + " end"), (7, prose(2, 90)), (7, prose(2, 90)), (11, None), (12, ""), (None, "no id"), (None, text)]
    rows += [(20 + n, prose(4, 300) + f" w{n}") for n in range(12)] + [(40, "one two"), (40, "two one"), (41, prose(6, 40_000))]
    docs = frame(rows)
    for extra in ((), ("own_mark", "KEPT_ID", "kept_mark", "found_spots", "slot", "__mark", "__spots")):
        for name in extra:
            docs = docs.withColumn(name, F.lit(name))
        out = st.keep_one(docs)
        got = out.collect()
        assert out.columns == docs.columns and all(r[name] == name for r in got for name in extra)
        assert sorted((r.doc_id is None, r.doc_id or 0, hash_of(r.text)) for r in got) == one_of_each(rows)
    assert st.keep_one(docs.limit(0)).count() == 0


def test_one_document_stays_of_a_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    want = one_of_each([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in st.keep_one(docs).collect()) == [d for _, d, _ in want]
