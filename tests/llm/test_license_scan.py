from __future__ import annotations

import random

from brute import base_labels, notices

from loamsift.llm import license_scan as L

TEXTS = [
    None, "", "Released under the MIT License.", "cc by CC BY cc, by; ccby cc  by", "GNU General Public\nLicense", "gnu gnu general public license license", "mit mit license mit license",
    "é apache license ßmit license", "apache" + " x" * 5000 + " license", "the mit license " * 400, "general public license", "CC-BY 4.0",
]


def test_base_columns_match_brute_force(docs_of):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[2])]
    got = sorted((tuple(r)[:6] for r in L.scan(docs_of(rows, extra=True)).collect()), key=repr)
    assert got == sorted(((i, *base_labels(t, L.BASE_PHRASES)) for i, t in rows), key=repr)


def test_whole_table(spark, sf, sf_tables):
    got = {r.doc_id: tuple(r)[:6] for r in L.op1_license_scan(spark, sf).collect()}
    for doc, text in sf_tables("documents").select("doc_id", "text").collect():
        assert got[doc] == (doc, *base_labels(text, L.BASE_PHRASES))


def test_notices_survive_edits(docs_of):
    notice = L.NOTICES["mit-notice"].split()
    edited = " ".join(["intro"] * 7 + notice[:12] + ["really"] + notice[12:20] + notice[21:] + ["tail"])
    row = L.scan(docs_of([(1, edited), (2, "no such words here at all")])).orderBy("doc_id").collect()
    assert row[0].labels == "mit-notice" and 0.8 <= row[0].score <= 1 and row[0].base_labels == ""
    assert row[0].spans[0].start == 7 and row[1].score == 0 and row[1].labels == ""


def plain(text):
    """labels and score by the plain version."""
    _, n, _, _, base = base_labels(text, L.BASE_PHRASES)
    own, best = notices(text, {k: v.split() for k, v in L.NOTICES.items()}, L.NOTICE_K, L.DIAGONAL_GAP, L.MIN_VOTES, L.MIN_COVERAGE)
    return ",".join(sorted(own | set(base.split(",") if base else []))), min(1.0, max(best, float(n > 0)))


def test_labels_and_score_match_the_plain_version(docs_of):
    rng = random.Random(8)
    texts = list(TEXTS)
    for notice in L.NOTICES.values():
        w = notice.split()
        texts.append(" ".join(["intro"] * rng.randrange(9) + w + ["end"]))
        for _ in range(3):
            edited = [x for x in w if rng.random() > 0.1]
            for _ in range(rng.randrange(6)):
                edited.insert(rng.randrange(len(edited)), rng.choice(["really", "the", "license"]))
            texts.append(" ".join(edited[rng.randrange(4) :]))
    texts += [" ".join(rng.choice(list(L.NOTICES.values())) for _ in range(4)) for _ in range(6)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.labels, r.score) for r in L.scan(docs_of(rows, extra=True)).collect()}
    for i, t in rows:
        labels, score = plain(t)
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-9, t


def test_labels_and_score_of_the_whole_table(spark, sf, sf_tables):
    got = {r.doc_id: (r.labels, r.score) for r in L.op1_license_scan(spark, sf).collect()}
    for doc, text in sf_tables("documents").select("doc_id", "text").collect():
        assert (got[doc][0], round(got[doc][1], 9)) == (plain(text)[0], round(plain(text)[1], 9))


def test_a_notice_at_the_end_of_a_long_span_is_found(docs_of):
    rows = [(1, "licensed under the apache " * 30 + L.NOTICES["apache-statement"]), (2, "this is free and " * 20 + L.NOTICES["unlicense"] + " tail" * 9)]
    got = {r.doc_id: r for r in L.scan(docs_of(rows)).collect()}
    assert got[1].labels == "apache,apache-statement" and got[1].score == 1 and got[2].labels == "unlicense" and got[2].score == 1
    assert [(s.start, s.stop) for s in got[2].spans] == [(80, 91)]


def test_empty_table(docs_of):
    assert L.scan(docs_of([])).count() == 0
