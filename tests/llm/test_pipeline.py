"""The pipeline's stages and run() against brute force on a small fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_simhash_trie, test_suffix_dedup
from tests.llm.conftest import prose
from tests.llm.test_stock_packing import check


def small_corpus():
    passage = prose(900, 70)
    rows = [(i, prose(i, 90, 40) + "\nread more here\n" + prose(100 + i, 60, 40), "aa", f"s{i % 2}") for i in range(16)]
    rows += [(20, rows[3][1], "aa", "s1"), (21, rows[4][1].replace("\n", " \n", 1), "aa", "s0")]
    rows += [(30 + i, prose(200 + i, 80, 40) + "\n" + passage + "\n" + prose(300 + i, 80, 40), "aa", "s0") for i in range(3)]
    return rows + [(40, None, "aa", "s0"), (41, "", "aa", "s0"), (42, "12 34", None, None)]


def test_stages_and_run(spark, frame, tmp_path):
    rows = small_corpus()
    docs = frame(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    (_, language), (_, lines), (_, near), (_, suffix), (_, pack) = corpus_pipeline.STAGES

    first = language(spark, docs, str(tmp_path))
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == {r[0] for r in rows if r[0] < 40}

    second = lines(spark, first, str(tmp_path))
    texts = {r.doc_id: r.text for r in second.collect()}
    assert texts == {r[0]: r[1].replace("\nread more here", "") for r in rows if r[0] < 40}

    third = near(spark, second, str(tmp_path))
    want = {d for _, d, _ in test_simhash_trie.one_of_each(list(texts.items()))}
    kept = {r.doc_id: r.text for r in third.collect()}
    assert set(kept) == want and 20 not in kept and kept.items() <= texts.items()

    fourth = suffix(spark, third, str(tmp_path))
    removed = {d: n for _, d, _, n, _, _ in test_suffix_dedup.brute(list(kept.items()))}
    final = [(r.doc_id, r.text) for r in fourth.collect()]
    assert fourth.columns == docs.columns
    assert {d: len(kept[d].encode()) - len(t.encode()) for d, t in final} == {d: n for d, n in removed.items() if n < len(kept[d].encode())}
    assert any(removed.values())

    check(final, pack(spark, fourth, str(tmp_path)).collect(), 0.5)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    check(final, whole.collect(), 0.5)


def test_stages_take_any_column_names(spark, frame, tmp_path):
    docs = frame([(i, prose(i, 80, 40), "aa", "s") for i in range(8)])
    for name in ("__spots", "__mark", "__row", "__dropped", "own_mark", "kept_id", "found_spots", "check_sum"):
        docs = docs.withColumn(name, F.lit(name))
    for _, function in corpus_pipeline.STAGES[1:4]:
        out = function(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and {r["__mark"] for r in out.collect()} == {"__mark"}


def test_empty_table(spark, frame, tmp_path):
    frame([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
