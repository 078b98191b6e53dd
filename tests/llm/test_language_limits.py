"""Language ID rejects what no learned language would write, and keeps clean documents."""

from __future__ import annotations

import random

from tests.llm.conftest import AWKWARD, prose
from tillwise.llm import ppm_language as ppm


def test_strangers_go_and_clean_documents_stay(frame):
    draw = random.Random(5)
    learned = [(i, prose(i, 30 + i % 60), "aa") for i in range(99)]
    learned += [(1000 + i, "".join(reversed(prose(200 + i, 30 + i % 60))), "bb") for i in range(120)]
    learned += [(1500, prose(3, 40_000), "aa")]
    random_texts = [(2000 + i, "".join(chr(draw.randint(33, 126)) for _ in range(draw.randint(60, 900))), "aa") for i in range(5)]
    other_script = [(3000 + i, "".join(chr(draw.randint(0x4E00, 0x5000)) for _ in range(draw.randint(60, 300))), "aa") for i in range(5)]
    model = ppm.fit(frame(learned))
    docs = frame(learned + random_texts + other_script + [(d, t) for d, t in AWKWARD])
    kept = ppm.identified(docs, model)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    assert {d for d, *_ in learned} <= set(got)
    assert not [d for d in got if d is not None and 2000 <= d < 4000]
    assert not {100, 101, 102} & set(got)
    assert got.count(104) in (0, 2, 3)  # copies are judged alike
    assert ppm.identified(docs.limit(0), model).count() == 0
    nothing = ppm.fit(docs.limit(0))
    assert ppm.identified(docs, nothing).count() == 0
