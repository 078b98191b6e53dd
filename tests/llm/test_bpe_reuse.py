from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm.conftest import AWKWARD, prose
from tillwise.llm import bpe_reuse
from tillwise.llm.bpe import Encoder
from tillwise.llm.common import documents, gear_table

ODD = ["a", "b", " ", "  ", "\n", "\t", "'ll", "'s", "'", "<|endoftext|>", "é", "中", "١", "1", "\x1c", "\xa0", "!", "ß", "\x85", "ǅ", "́", "\r\n", "😀", "²"]


@pytest.fixture(scope="module")
def encoder():
    return Encoder()


def expected(encoder, text):
    ids = encoder.library.encode(text or "", add_special_tokens=False).ids
    said = encoder.library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


def test_encoder_equals_library(encoder):
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choice(ODD) for _ in range(draw.randint(0, 12)))
        ids = encoder.library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == ids
        assert encoder.decode(np.array(ids, dtype=np.uint32)).decode() == encoder.library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("shortest, mean, longest", [(1, 4, 9), (3, 8, 40), (256, 1024, 8192)])
def test_chunks_joined_equal_whole(encoder, monkeypatch, shortest, mean, longest):
    for name, value in (("SHORTEST", shortest), ("MEAN", mean), ("LONGEST", longest)):
        monkeypatch.setattr(bpe_reuse, name, value)
    draw, table, special = random.Random(2), gear_table(2), tuple(encoder.special)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 60))) for _ in range(300)]
    texts += [prose(i, 3000) for i in range(2)] + ["a" * 500, " " * 300, "ab" * 20_000 if longest > 1000 else "ab" * 200]
    for text in texts:
        parts = bpe_reuse.chunks(text, special, table)
        assert "".join(parts) == text
        got = bpe_reuse.assembled(encoder, parts, {0: encoder.encode(parts[0])} if parts and parts[0] not in special else {})
        assert got.tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_documents(frame, encoder):
    shared = prose(9, 3000)
    rows = [(i, prose(i, 400) + " " + shared + prose(50 + i, 300)) for i in range(4)] + [(10, shared), (11, shared), *AWKWARD]
    got = bpe_reuse.encode_documents(frame(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(
        (d is None, d, *expected(encoder, t)) for d, t in rows
    )
    assert sum(r.n_reused for r in got if r.doc_id in range(4)) > 20
    assert bpe_reuse.encode_documents(frame([])).count() == 0


def test_whole_table(spark, encoder):
    docs = documents(spark, "/root/testdata/sf0.001")
    got = {r.doc_id: tuple(r)[1:4] for r in bpe_reuse.encode_documents(docs).collect()}
    assert got == {r.doc_id: expected(encoder, r.text) for r in docs.collect()}
