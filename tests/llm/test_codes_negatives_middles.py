"""Language codes, hard negatives and fill-in-the-middle against brute force, and on odd rows and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from fleetgauge.llm import fim, hard_negatives, language_id, queries

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n long, form string, score string, lang_pred string, h1 string"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(11)
    pool = {"en": "the and of water house running", "fr": "le et de maison été courant", "日": "日本 語 東京 大学 水"}
    rows = [(i, " ".join(rng.choices(pool[g].split(), k=rng.randint(1, 60))), g, "s", i, "f", "s", "p", "h")
            for i, g in enumerate(rng.choices(list(pool), k=150))]
    rows += [(None, "no id", "en", *[None] * 6), (200, None, "fr", *[None] * 6), (201, "", "fr", *[None] * 6), (202, "123 -- ½ Ⅷ 🙂\n", None, *[None] * 6),
             (203, "été " * 50_000, None, *[None] * 6), (204, "a<P>b", "en", *[None] * 6), (205, "é", "fr", *[None] * 6), (None,) * 9]
    rows += [rows[0], rows[0], (1, "another text under one id", None, *[None] * 6)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("languages", [2, 3, 4, 6, 7, 40])
def test_codewords_differ_and_no_bit_is_constant(languages):
    code = language_id.codewords(languages)
    assert language_id.least_distance(code) >= 1 and (code.min(axis=0) < code.max(axis=0)).all()
    if 3 <= languages <= 6:
        assert language_id.least_distance(code) == 1 << (languages - 2)
    if languages >= 7:
        assert language_id.least_distance(code) >= 7


def test_decoding_corrects_wrong_bits_and_flags_close_calls():
    code = language_id.codewords(5)
    ones = np.ones(code.shape[1])
    model = language_id.Model(list("abcde"), code, np.zeros((code.shape[1], 1)), ones, 0 * ones, ones)
    clear = (2.0 * code - 1) * 4
    best, share, unsure, off = model.decode(clear)
    assert best.tolist() == [0, 1, 2, 3, 4] and not unsure.any() and not off.any() and share.min() > 0.9
    flipped = clear.copy()
    flipped[:, :3] *= -1
    best, _, unsure, off = model.decode(flipped)
    assert best.tolist() == [0, 1, 2, 3, 4] and off.tolist() == [3] * 5 and not unsure.any()
    assert model.decode((clear[:1] + clear[1:2]) / 2)[2].all()


def test_grams_are_those_of_each_text_alone():
    texts = ["Abc dé", "", None, "x", "1 2  3", "日本", "Zz" * 40]
    found = {}
    for text, bucket in language_id.grams(pa.array(texts)):
        for t, b in zip(text.tolist(), bucket.tolist(), strict=True):
            found.setdefault(t, []).append(b)
    alone = {i: sorted(b for _, bs in language_id.grams(pa.array([t])) for b in bs.tolist()) for i, t in enumerate(texts)}
    assert {i: sorted(found.get(i, [])) for i in alone} == alone
    assert not alone[1] and not alone[2] and len(alone[3]) == 6


def test_blocks_do_not_change_margins(monkeypatch):
    rng = np.random.default_rng(3)
    texts = pa.array(["".join(rng.choice(list("abé 1"), n)) for n in (0, 1, 7, 300, 2, 90)])
    weights = rng.normal(size=(4, language_id.BUCKETS)).astype(np.float32)
    whole = language_id.margins(texts, weights)
    monkeypatch.setattr(language_id, "BLOCK", 13)
    assert np.allclose(language_id.margins(texts, weights), whole)


def test_odd_texts_get_a_language(spark, odd, empty):
    model = language_id.fit(odd, queries.fold(3) != 1)
    assert model.languages == ["en", "fr", "日"]
    rows = language_id.score(odd, model).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in rows:
        got = r["lang_pred_"]
        if r.doc_id not in (None, 1):
            letters = any(unicodedata.category(c).startswith("L") for c in texts[r.doc_id] or "")
            assert (got == "und") == (not letters)
            assert got == "und" or 0 < r["score_"] <= 1
            assert r.lang is None or got in (r.lang, "und") or r.doc_id == 204
    assert {r["lang_pred_"] for r in rows if r.doc_id in (203, 205)} == {"fr"}
    assert language_id.score(empty, model).count() == 0
    nothing = language_id.fit(empty, queries.fold(3) != 1)
    assert {r["lang_pred_"] for r in language_id.score(odd, nothing).collect()} == {"und"}
    single = language_id.fit(odd.filter("lang = 'fr'"), queries.fold(3) != 1)
    assert {r["lang_pred_"] for r in language_id.score(odd, single).collect()} == {"fr", "und"}


def test_held_out_language_accuracy(spark):
    got = queries.QUERIES["op11_output_codes"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out")
    assert got.count() > 200 and got.selectExpr("avg(cast(lang_pred = lang AS double))").first()[0] >= 0.99


def mined(rows, positives=5, negatives=10):
    """Brute force over (id, vector, label)."""
    good = [(i, [int(np.floor(256.0 * float(x))) for x in v], lab) for i, v, lab in rows
            if lab is not None and v is not None and all(x is not None and np.isfinite(x) and abs(x) * 256 <= 1 << 24 for x in v)]
    good = [(i, v, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab) for i, v, lab in good]
    out = []
    for k, (anchor, v, lab) in enumerate(good):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), i is None, i or 0, other) for j, (i, w, other) in enumerate(good) if j != k]
        for p in sorted(s[:3] for s in scored if s[3] == lab)[:positives]:
            fits = sorted(s[:3] for s in scored if s[3] != lab and -30 * p[0] <= -100 * s[0] <= -90 * p[0])[:negatives]
            out += [(anchor, None if p[1] else p[2], rank, None if q[1] else q[2], -p[0], -q[0]) for rank, q in enumerate(fits, 1)]
    return sorted(map(repr, out))


def mine_rows(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, planes int, row string").repartition(3)
    got = hard_negatives.mine(df, label=hard_negatives.relabelled(), **kw)
    return sorted(repr(tuple(r)) for r in got.drop("positive_rank").collect())


def test_hard_negatives_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i * 10, [float(np.float32(x)) for x in rng.integers(-300, 300, 13) / 256 + 0.001], int(i % 3)) for i in range(90)]
    rows += [(5, rows[0][1], 0), (5, rows[0][1], 1), (100, rows[3][1], 2), (100, rows[10][1], 1), (0, [], 1), (200, [0.5], 1), (None, rows[4][1], 1),
             (7, None, 1), (8, rows[2][1], None), (9, [1.0, None], 1), (300, [NAN] * 13, 1), (400, [1.0, INF], 2), (500, [65536.0, 0.0], 1), (600, [65537.0], 1),
             (700, [-0.0] * 13, 4), (None, None, None)]
    wide = [(*r, "a", 1, "b") for r in rows]
    want = mined(rows)
    assert len(want) > 100
    assert mine_rows(spark, wide) == want
    assert mine_rows(spark, wide, anchor_block=4, candidate_block=9) == want
    assert mine_rows(spark, wide[:1]) == [] == mine_rows(spark, [])


def test_lookups_give_inner_products():
    rng = np.random.default_rng(2)
    for bits, dims in ((1, 1), (9, 64), (12, 20), (25, 3)):
        a, b = (rng.integers(-(1 << bits - 1), 1 << bits - 1, (7, dims)) for _ in range(2))
        packed = hard_negatives.planes_of(b, bits)
        assert np.array_equal(hard_negatives.scores_of(hard_negatives.tables_of(a, packed.shape[1]), packed), b @ a.T)


def test_wavelet_ranks_against_counts():
    rng = np.random.default_rng(4)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, n).astype(np.uint8)
        matrix, places = fim.WaveletMatrix(symbols), np.arange(n + 1)
        for s in range(4):
            assert matrix.rank(s, places).tolist() == [0, *np.cumsum(symbols == s).tolist()]


UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def test_units_and_places_against_the_pattern():
    texts = ["", "abc", "a b", "éa1b🙂cd", " \n", "x" * 200, "日本ab", "Zé"] * 2
    data, bounds = fim.utf8(pa.array(texts))
    units = fim.Units(data, bounds)
    split = [UNIT.findall(t) for t in texts]
    assert units.n.tolist() == [len(s) for s in split]
    for k in range(9):
        at = units.places(np.minimum(k, units.n))
        for t, (s, a, b) in enumerate(zip(split, at.tolist(), bounds.tolist(), strict=False)):
            assert data[b:a].tobytes().decode() == "".join(s[:k])
        assert units.code_points(bounds[:-1], at).tolist() == [len("".join(s[:k])) for s in split]


def middle_out(doc_id, text):
    text, digest = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(units), "plain", None, None, text)
    if h[3] % 100 < 20:
        return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_middles_of_odd_texts_and_back(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(i, f"a<{i}S><S <P<M é<") for i in range(300, 340)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = fim.transform(docs).withColumn("back", fim.restored())
    want = [(*middle_out(i, t), t or "") for i, t in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    kept = fim.transform(odd)
    assert kept.count() == odd.count() and kept.columns == [c for c in odd.columns if c != "text"] + ["n_", "form_", "prefix_chars", "middle_chars", "output"]
    assert fim.transform(empty).count() == 0


def test_middles_against_sql_over_whole_texts(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLE["op13_fill_in_middle"])
    got = queries.QUERIES["op13_fill_in_middle"](spark, SF)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
