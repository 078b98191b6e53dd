from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spots string, key int"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text[, lang[, source]]) as documents with extra columns of clashing names."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), "x", 1) for r in rows]
        return spark.createDataFrame([(a, b, c, d, n, s, k) for a, b, c, d, n, s, k in full], SCHEMA)

    return make


def prose(seed: int, words: int, vocabulary: int = 500) -> str:
    draw = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéüß"
    known = random.Random(vocabulary)
    stems = ["".join(known.choices(letters, k=known.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(draw.choice(stems) + draw.choice(["", "", "", "", ",", ".", ".\n"]) for _ in range(words))


AWKWARD = [(100, None), (101, ""), (102, " \n\t "), (103, "x"), (None, "null id here"), (104, "same row"), (104, "same row"), (104, "same id, other text")]
