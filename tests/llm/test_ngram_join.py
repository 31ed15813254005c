from __future__ import annotations

import random

import numpy as np
import pytest
from brute import components, row_components

from loamsift.llm import ngram_join as J


def family(seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghij") for _ in range(rng.choice([3, 5, 8, 20, 30]))] for _ in range(8)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice("abcdefghijXYZ")
        w += [rng.choice("qrstuv") for _ in range(rng.randrange(4) if rng.random() < 0.3 else 0)]
        rows.append((i, " ".join(w)))
    return rows + [(150, None), (151, ""), (152, " \t\n"), (153, "a"), (154, "A"), (155, "word " * 20_000)]


@pytest.mark.parametrize(("hot", "part", "k"), [(20_000, 1_024, 5), (3, 2, 5), (2, 3, 2), (5, 7, 1)])
def test_against_brute_force(docs_of, hot, part, k):
    rows = family(k)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.link(docs_of(rows, extra=True), 75, k, hot, part, part).collect())
    assert got == components(rows, 75, k)


def test_whole_table(spark, sf, sf_tables):
    rows = [tuple(r) for r in sf_tables("documents").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in J.op4_ngram_jaccard(spark, sf).collect()) == components(rows)


def test_repeated_rows_and_null_ids(docs_of):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (2, text.upper()), (None, text), (None, None), (3, "other")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.link(docs_of(rows)).collect()), key=repr)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (None, 3, None), (None, 0, None), (3, 1, 3)], key=repr)
    kept = sorted((r.doc_id for r in J.keep_one(docs_of(rows)).collect()), key=repr)
    assert kept == sorted([1, 1, 3, None, None], key=repr)


@pytest.mark.parametrize(("hot", "part", "k"), [(20_000, 1_024, 5), (3, 2, 5), (2, 3, 2)])
def test_repeated_ids_against_brute_force(docs_of, hot, part, k):
    rows = [(i // 3, t) for i, t in family(k)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.link(docs_of(rows, extra=True), 75, k, hot, part, part).collect())
    assert got == row_components(rows, 75, k)


def test_texts_of_one_id_link_each_for_itself(docs_of):
    rng = random.Random(1)
    a = " ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(200))
    b = " ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(200))
    rows = [(3, a), (5, a), (5, b), (9, b + " more")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.link(docs_of(rows)).collect())
    assert got == row_components(rows) == [(3, 196, 3), (5, 196, 3), (5, 196, 5), (9, 197, 5)]
    assert sorted((r.doc_id, r.text) for r in J.keep_one(docs_of(rows)).collect()) == [(3, a), (5, b)]


def test_products_agree():
    """Entry by entry, dense and by both: the same overlaps."""
    rng = np.random.default_rng(2)
    members = [J.Member(i, i % 2, np.unique(rng.integers(0, 400, 60).astype(np.uint64))) for i in range(40)]
    a, b = members[::2], members[1::2]
    plain = lambda x, y: [[len(np.intersect1d(p.grams, q.grams)) for q in y] for p in x]
    for ratio in (0, 100, 10**9):
        J.DENSE_RATIO = ratio
        assert J._overlaps(a, b).tolist() == plain(a, b) and J._overlaps(a, a).tolist() == plain(a, a)
    J.DENSE_RATIO = 100


def test_empty_table(docs_of):
    assert J.link(docs_of([])).count() == 0
    assert J.keep_one(docs_of([])).count() == 0
