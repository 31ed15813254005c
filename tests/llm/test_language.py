from __future__ import annotations

import zlib

import numpy as np
from brute import languages

from loamsift.llm import _common as C
from loamsift.llm import language_id as L


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = L.op7_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() / got.count() > 0.98
    assert got.where("score < 0 OR score > 1").count() == 0


def test_predictions_match_a_plain_version(spark, sf, sf_tables):
    """Sets of n-grams in place of bit-sliced filters: the same languages, and scores but for what is left of false positives."""
    rows = sf_tables("documents").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    want = dict(zip([r.doc_id for r in rows], languages([(r.text, r.lang) for r in rows if r.lang is not None and not held(r.doc_id)], [r.text for r in rows], L.RATE_SHARE, L.GRAMS_PER_LANGUAGE), strict=True))
    for r in L.op7_language_id(spark, sf).collect():
        assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 0.01 and r.held_out == held(r.doc_id)


def grams(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return L.letter_grams(raw, np.array([0, len(raw)]))


def test_odd_texts(spark, docs_of):
    model = L.BitSlicedFilter.build(["de", "en"], {"de": grams("der hund")[0], "en": grams("the cat")[0]})
    rows = [(1, None), (2, ""), (3, "12 !? ²"), (4, "THE  cat"), (5, "Der"), (5, "Der"), (None, "the"), (6, "мир"), (7, "cat " * 60_000)]
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in L.predict(docs_of(rows, extra=True), model).collect()), key=repr)
    by = {r[0]: r[1] for r in got}
    assert by == {1: "und", 2: "und", 3: "und", 4: "en", 5: "de", None: "en", 6: by[6], 7: "en"} and by[6] in ("de", "en")
    assert len(got) == len(rows) and all(0 <= r[2] <= 1 for r in got) and {r[2] for r in got if r[1] == "und"} == {0.0}
    assert L.predict(docs_of([]), model).count() == 0


def test_no_learned_language(spark, docs_of):
    model = L.train(docs_of([(1, "abc")]))
    assert model.languages == [] and L.predict(docs_of([(1, "abc")]), model).first().lang_pred == "und"


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(4)
    languages = [f"l{i:03d}" for i in range(70)]
    members = {lang: rng.integers(0, 2**63, 500, dtype=np.uint64) for lang in languages}
    f = L.BitSlicedFilter.build(languages, members, 16)
    for i in (0, 63, 64, 69):
        assert (f.lookup(members[languages[i]], i // 64) >> np.uint64(i % 64) & np.uint64(1)).all()
    strange = rng.integers(0, 2**63, 100_000, dtype=np.uint64)
    hit = (f.lookup(strange, 1) >> np.uint64(5) & np.uint64(1)).mean()
    assert abs(hit - f.false_rate[69]) < 1e-3
    counts = f.counts(strange, np.zeros(len(strange), int), 1)
    assert counts.max() < 60


def test_gram_rows_do_not_mix():
    texts = ["ab", "", "Éa b", "c"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    h, r, has = L.letter_grams(raw, offs)
    for i, t in enumerate(texts):
        assert sorted(h[r == i].tolist()) == sorted(grams(t)[0].tolist())
    assert has.tolist() == [True, False, True, True] and C.SLICE_BYTES
