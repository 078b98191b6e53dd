"""Quality, language, fingerprints, rules, lines and chat views against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import AWKWARD, prose
from tillwise.llm import chat_views, fm_quality, mcd_rules, ppm_language, site_lines
from tillwise.llm import gear_fingerprint as gf
from tillwise.llm.common import documents

SF = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


# Quality


def test_quality_of_held_out_documents(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in fm_quality.score(docs, fm_quality.fit(docs, labels)).collect()}
    assert len(got) == docs.count() and all(r.held_out == held_out(d) and 0 <= r.score <= 1 for d, r in got.items())
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())
    rows = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.97 and len(bad) >= 5


def test_pairs_by_sum_of_squares():
    draw = np.random.default_rng(1)
    m = fm_quality.Machine(0.5, draw.normal(size=50), draw.normal(size=(50, 3)))
    number, x = np.array([1, 4, 9, 2, 30]), draw.normal(size=5)
    raw, _ = m.raw(np.array([0, 3, 5]), number, x)
    for row, (a, b) in enumerate(((0, 3), (3, 5))):
        pairs = sum(m.factors[number[i]] @ m.factors[number[j]] * x[i] * x[j] for i in range(a, b) for j in range(i + 1, b))
        assert np.isclose(raw[row], 0.5 + m.weights[number[a:b]] @ x[a:b] + pairs)


def test_quality_awkward_rows(frame, spark):
    labels = spark.createDataFrame([(100, 1), (101, None), (103, 0), (103, 1), (None, 1), (999, 0)], "doc_id long, quality int")
    docs = frame(AWKWARD)
    out = fm_quality.score(docs, fm_quality.fit(docs, labels)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out)
    none = fm_quality.fit(docs, labels.limit(0))
    assert {r.score for r in fm_quality.score(docs, none).collect()} and fm_quality.score(frame([]), none).count() == 0


def test_word_features_do_not_depend_on_neighbours():
    texts = [b"one two two", b"", b" x\n", prose(1, 50).encode()]
    together, apart = fm_quality.features(texts, [3, None, 0, -1]), [fm_quality.features([t], [d]) for t, d in zip(texts, [3, None, 0, -1], strict=True)]
    assert np.array_equal(together[1], np.concatenate([a[1] for a in apart]))
    assert np.allclose(together[2], np.concatenate([a[2] for a in apart]))


# Language


def test_language_of_held_out_documents(spark):
    docs = documents(spark, SF)
    out = ppm_language.predict(docs, ppm_language.fit(docs)).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in out if r.held_out and r.lang_pred != "und"]
    assert len(out) == docs.count() and all(r.held_out == held_out(r.doc_id) for r in out)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text)) for r in out)


def test_code_is_a_distribution_and_exact(frame):
    docs = frame([(i, prose(i, 60, 10), "aa") for i in range(40)] + [(50 + i, prose(i, 60, 99), "bb") for i in range(40)])
    m = ppm_language.fit(docs, least=4)
    assert m.languages == ["aa", "bb"]
    p = np.exp2(-m.bits.astype(np.float64))
    p[:, -1, :] *= 256 - len(np.unique(m.byte_class[m.byte_class < m.step.shape[1] - 1]))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    texts = [b"", b"abc", "größe 1\x00".encode(), prose(7, 300).encode()]
    got = ppm_language.code_lengths(m, texts)
    classes = m.step.shape[1]
    for text, bits in zip(texts, got, strict=True):
        want, state = np.zeros(2), 0
        for b in ppm_language.PAD:
            state = m.step[state, m.byte_class[b]]
        past = ppm_language.PAD + text
        for i in range(len(text)):
            state = 0
            for b in past[i : i + 3]:
                state = m.step[state, m.byte_class[b]]
            want += m.bits[state, m.byte_class[text[i]]]
        assert np.allclose(bits, want, rtol=1e-5) and classes > 1


def test_language_awkward_rows(frame):
    rows = [(i, prose(i, 40, 10), "aa", "s") for i in range(20)] + [(d, t, None, None) for d, t in AWKWARD] + [(200, "123 !?", "aa", "s")]
    docs = frame(rows)
    out = {(r.doc_id, r.lang_pred, r.score) for r in ppm_language.predict(docs, ppm_language.fit(docs, least=2)).collect()}
    assert {(100, "und", 0.0), (101, "und", 0.0), (102, "und", 0.0), (200, "und", 0.0), (103, "aa", 1.0)} <= out
    nothing = ppm_language.fit(frame([]))
    assert {r.lang_pred for r in ppm_language.predict(docs, nothing).collect()} == {"und"}
    kept = ppm_language.identified(docs, ppm_language.fit(docs, least=2))
    assert kept.columns == docs.columns and {100, 101, 102, 200}.isdisjoint(r.doc_id for r in kept.collect())
    assert ppm_language.identified(docs, nothing).count() == 0


# Fingerprints


def test_fingerprints(frame):
    base = prose(1, 800)
    rows = [(i, prose(i, 10 + 37 * i)) for i in range(30)] + [(40, base), (41, base), (42, "start " + base), *AWKWARD]
    got = gf.fingerprints(frame(rows)).collect()
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = {}
    for (d, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        want.setdefault(d, []).append((t, n))
    assert len(got) == len(rows)
    fp = lambda t: gf.chunk_sets([t.encode()])[0]
    for r in got:
        choices = [(t, n) for t, n in want[r.doc_id] if hashlib.sha256(gf.edited(t, n).encode()).hexdigest() == r.edited_sha256 and len(t) == r.n_chars]
        t, n = choices[0]
        new = gf.edited(t, n)
        assert len(t) // 2 > len(n) or len(new) == len(t)
        assert r.fingerprint == gf.as_text(fp(t)) and r.edited_fingerprint == gf.as_text(fp(new))
        assert r.near_edited == gf.likeness(fp(t), fp(new)) and gf.from_text(r.fingerprint) == fp(t)
        assert any(r.near_next == gf.likeness(fp(t), fp(m)) for _, m in want[r.doc_id])
    by = {r.doc_id: r for r in got}
    assert by[40].fingerprint == by[41].fingerprint and by[40].near_next == 1.0 and by[41].near_next > 0.9
    only = gf.fingerprints(frame([(7, "abcdef")])).collect()
    assert only[0].near_next == 1.0 and only[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert gf.fingerprints(frame([])).count() == 0


def test_chunks_resist_shifts():
    text = prose(3, 4000).encode()
    a, b = gf.chunk_sets([text])[0], gf.chunk_sets([b"\xc3\xa4 new beginning " + text[:9000] + b"middle" + text[9000:]])[0]
    assert gf.likeness(a, b) > 0.97
    assert max(a.values()) <= gf.LONGEST and 30 < np.mean(list(a.values())) < 100
    alone, beside = gf.boundaries([text]), gf.boundaries([b"other text" * 20, text, b"end"])
    assert alone[0] == beside[1]


# Rules


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts(frame, spark):
    rows = [(i, prose(i, 150, 12)) for i in range(20)] + [(30, "a b c " * 40), (31, "a b c d a b c e a b c"), (32, "a a a a"), (33, "x\ny\nx\n \n \ny"), *AWKWARD]
    got = mcd_rules.judge(frame(rows)).collect()
    plain = lambda r: (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert sorted(map(str, map(plain, got))) == sorted(str((d, *slow_counts(t))) for d, t in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert not any(r.kept for r in got if r.base_failed)
    assert mcd_rules.judge(frame([])).count() == 0
    docs = documents(spark, "/root/testdata/sf0.001")
    want = {r.doc_id: slow_counts(r.text) for r in docs.collect()}
    assert {r.doc_id: plain(r)[1:] for r in mcd_rules.statistics(docs).collect()} == want


def test_outliers_are_rejected_and_clean_documents_stay(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [(labels[r.doc_id], r) for r in mcd_rules.judge(documents(spark, SF)).collect() if r.doc_id in labels]
    clean = [r for q, r in got if q == 1 and not r.base_failed]
    junk = [r for q, r in got if q == 0]
    assert np.mean([r.kept for r in clean]) > 0.98
    assert np.mean([r.kept for r in junk]) < 0.5


def test_estimate_is_robust(spark):
    draw = np.random.default_rng(2)
    good = draw.normal([1.6, 0.3, 0.3, 0.4], [0.1, 0.05, 0.06, 0.07], (400, 4))
    good[:, 3] += 0.5 * (good[:, 0] - 1.6)
    far = draw.normal([2.4, 1.5, 0.3, 0.4], 0.05, (80, 4))
    rows = [("g", *map(float, v)) for v in np.concatenate([good, far])]
    r = mcd_rules.estimates(spark.createDataFrame(rows, ["group", *mcd_rules.DIMENSIONS])).first()
    assert np.allclose([r[f"mean{i}"] for i in range(4)], [1.6, 0.3, 0.3, 0.4], atol=0.03)
    factor = np.zeros((4, 4))
    for i in range(4):
        for j in range(i + 1):
            factor[i, j] = r[f"l{i}{j}"]
    solved = np.linalg.solve(factor, (np.concatenate([good, far]) - [r[f"mean{i}"] for i in range(4)]).T)
    distance = (solved**2).sum(axis=0) / r["scale"]
    assert (distance[400:] > mcd_rules.CUTOFF).all() and (distance[:400] < mcd_rules.CUTOFF).mean() > 0.99


def test_estimate_bears_a_third_of_copies(spark):
    draw = np.random.default_rng(3)
    rows = []
    for share, at in ((0.28, 0.5), (0.34, 0.5), (0.4, -0.4)):
        good = draw.normal([1.6, 0.3, 0.3, 0.4], [0.1, 0.05, 0.06, 0.07], (800, 4))
        far = draw.normal([1.6 + at, 1.0, 0.3, 0.9], 0.001, (round(800 * share / (1 - share)), 4))
        rows += [(str(share), i < 800, *map(float, v)) for i, v in enumerate(np.concatenate([good, far]))]
    vectors = spark.createDataFrame(rows, ["group", "good", *mcd_rules.DIMENSIONS])
    found = mcd_rules.estimates(vectors.drop("good")).collect()
    assert len(found) == 3
    for r in found:
        good, v = (np.array([x for x in col]) for col in zip(*[(x[1], x[2:]) for x in rows if x[0] == r["group"]], strict=True))
        factor = np.array([[r[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
        solved = np.linalg.solve(factor, (v - [r[f"mean{i}"] for i in range(4)]).T)
        distance = (solved**2).sum(axis=0) / r["scale"]
        assert (distance[~good] > mcd_rules.CUTOFF).all() and (distance[good] < mcd_rules.CUTOFF).mean() > 0.99


def test_rules_are_native(spark):
    plan = mcd_rules.judge(documents(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Lines and chats


def sql(query, **tables):
    db = duckdb.connect()
    for name, table in tables.items():
        db.register(name, table)
    return db.sql(query).fetchall()


def test_page_lines_equal_sql(spark):
    rows = [(i, f"https://A.example/{i}", f"<p>menu</p><p>text {i}</p><!-- x\n --><SCRIPT>no()</script><b>menu</b>") for i in range(10)]
    rows += [(20, None, "<p>menu"), (21, "https://b.example?x", None), (22, "no host", ""), (23, "https://a.example", "menu"), (23, "https://a.example", "menu"), (None, "ftp://c", "<<>>")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, host int")
    got = site_lines.clean_pages(pages).collect()
    want = sql(site_lines.ORACLE, pages=pages.toArrow())
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.text for r in got if r.page_id in range(10)} == {f"text {i}" for i in range(10)}
    assert site_lines.clean_pages(pages.limit(0)).count() == 0


def test_document_lines(frame):
    rows = [(i, f"notice\nown {i}\n\nnotice", "aa", "s1") for i in range(8)] + [(10, "notice\nother", "aa", "s2"), (11, "notice", "aa", "s1")]
    rows += [(12, None, None, "s1"), (13, "", "aa", None), (14, " \n", "aa", "s1"), (15, "notice\n", "aa", None)]
    docs = frame(rows)
    out = {r.doc_id: (r.text, r.n_chars) for r in site_lines.clean_documents(docs).collect()}
    assert site_lines.clean_documents(docs).columns == docs.columns
    assert out[3] == ("own 3\n", 6) and out[10] == ("notice\nother", 12) and 11 not in out
    assert out[12] == (None, None) and out[13] == ("", 0) and out[14] == (" \n", 2) and out[15] == ("notice\n", 7)


def test_planted_lines_of_a_whole_table_go_and_no_others(spark):
    docs = documents(spark, "/root/testdata/sf0.1").select("doc_id", "text", "source", "n_chars")
    rows = docs.collect()
    pages, on = Counter(r.source for r in rows), Counter()
    for r in rows:
        on.update((r.source, x) for x in set((r.text or "").split("\n")) if x.strip(" "))
    planted = Counter(x for (_, x), n in on.items() if n > 40).most_common()
    assert planted == [(planted[0][0], len(pages))] and max(n / pages[s] for (s, _), n in on.items()) < site_lines.RATIO
    got = {r.doc_id: r.text for r in site_lines.clean_documents(docs).collect()}
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if x != planted[0][0]) for r in rows if r.text is not None}
    assert got.items() <= want.items() and got != {r.doc_id: r.text for r in rows}
    assert all(not want[r.doc_id].strip() for r in rows if r.doc_id not in got)


def test_chat_views_equal_sql(spark, monkeypatch):
    rows = [(1, t, r, f"{r} says {t}") for t, r in enumerate(["system", "ann", "bob", "ann", "cy", "bob"] * 120)]
    rows += [(2, 0, None, None), (2, None, "ann", "ü"), (2, 0, "ann", "x"), (2, 0, "ann", "x"), (3, 0, "system", "alone"), (None, 1, "bob", "hi"), (None, 0, "cy", "")]
    chats = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, name string")
    got = chat_views.views(chats).collect()
    want = sql(chat_views.ORACLE, conversations=chats.toArrow())
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    for who in ("ann", "bob", "cy"):
        own = sorted((r for r in got if r.conv_id == 1 and r.perspective == who), key=lambda r: r.position)
        text = "".join(r.rendered for r in own)
        assert [r.position for r in own] == list(range(720))
        assert all(text[r.start :].startswith(r.rendered) for r in own[::97])
        masked = {text[r.mask_start : r.mask_end] for r in own}
        assert masked == {""} | {f"{who} says {r.turn}<|im_end|>" for r in own if r.role == "assistant"}
        assert {r.name for r in own if r.role == "user"} == {"ann", "bob", "cy"} - {who}
    assert chat_views.views(chats.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op4_chat_views", "op9_site_lines"])
def test_queries_equal_their_sql(spark, name):
    from tillwise.llm.queries import ORACLES, QUERIES

    table = {"op4_chat_views": "conversations", "op9_site_lines": "pages"}[name]
    want = sql(ORACLES[name], **{table: duckdb.sql(f"SELECT * FROM '{SF}/{table}.parquet'").arrow()})
    got = QUERIES[name](spark, SF)
    columns = duckdb.connect()
    columns.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert got.columns == columns.sql(ORACLES[name]).columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
