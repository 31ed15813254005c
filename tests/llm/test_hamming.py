from __future__ import annotations

import numpy as np
import pytest

from loamsift.llm import hamming_search as H


def exact(ids, x, k=20, every=20):
    out = {}
    for i in np.flatnonzero(np.array(ids) % every == 0):
        s = (x * x[i]).sum(1)
        others = np.array([j for j in range(len(ids)) if ids[j] != ids[i]], int)
        best = others[np.lexsort((np.array(ids)[others], -s[others]))][:k] if len(others) else others
        out[ids[i]] = [(ids[j], s[j]) for j in best]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")


def test_recall(spark, sf):
    t = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = [r.vec_id for r in t], np.array([r.embedding for r in t], np.float64)
    want, got = exact(ids, x), {}
    for r in H.op6_hamming_search(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and all((a[2], -a[1]) >= (b[2], -b[1]) for a, b in zip(rows, rows[1:], strict=False))
        hits += len({r[1] for r in rows} & {w[0] for w in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_small_tables_are_answered_in_full(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(12, 6)).astype(np.float32).astype(np.float64) * rng.choice([1, 5], (12, 1))
    x[7] = x[3]
    x[0] = x[3]
    ids = [0, 20, 40, 3, 5, 6, 8, 9, 11, 60, 13, 14]
    got = {}
    for r in H.search(frame(spark, ids, x)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, rows in exact(ids, x).items():
        assert [(a, pytest.approx(b)) for a, b in rows] == [(v, s) for _, v, s in sorted(got[q])]


def test_copies_beyond_k(spark):
    x = np.tile([[1.0, 2.0, 3.0]], (60, 1))
    got = {}
    for r in H.search(frame(spark, list(range(60)), x), k=5, every=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert got and all([v for _, v in sorted(rows)] == [i for i in range(7) if i != q][:5] for q, rows in got.items())


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, [2.0, 1.0]), (None, [1.0, 1.0]), (20, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in H.search(df).collect())
    assert got == [(0, 1, 7), (0, 2, 20), (20, 1, 7), (20, 2, 0)]
    assert H.search(df.limit(0)).count() == 0
    assert H.search(df.where("vec_id = 0")).count() == 0
    assert H.search(df.where("vec_id in (0, 7, 20)"), block=1).count() == 4


def test_each_width_is_searched(spark):
    """One stray wider vector takes nothing from the others; a second one of its width answers it."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(41, 2))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(60, [1.0, 2.0, 3.0])]
    got = H.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.count() == 60 and got.where("query_id = 60").count() == 0
    got = H.search(spark.createDataFrame([*rows, (61, [1.0, 0.0, 0.0])], "vec_id long, embedding array<double>"))
    assert got.count() == 61 and [tuple(r) for r in got.where("query_id = 60").collect()] == [(60, 1, 61, 1.0)]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocks_of_queries_meet_all_rows(spark, block):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 5))
    x[40] = x[20]
    ids, got = list(range(200)), {}
    for r in H.search(frame(spark, ids, x), k=4, every=20, block=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    x = x.astype(np.float32).astype(np.float64)
    want = exact(ids, x, 4)
    hits = sum(len({v for _, v in got[q]} & {v for v, _ in rows}) for q, rows in want.items())
    assert set(got) == set(want) and all([r for r, _ in sorted(v)] == [1, 2, 3, 4] for v in got.values()) and hits >= 0.9 * 40


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes, queries = rng.integers(0, 256, (300, 4), dtype=np.uint8), rng.integers(0, 256, (20, 4), dtype=np.uint8)
    codes[:20] = queries
    for radius in (0, 3, 9, 14):
        found = [(int(q), int(r)) for a, b, _ in H.MultiIndex(codes).within(queries, radius) for q, r in zip(a, b, strict=True)]
        apart = np.bitwise_count(queries[:, None] ^ codes[None]).sum(2)
        assert len(found) == len(set(found)) and set(found) == set(zip(*map(np.ndarray.tolist, np.nonzero(apart <= radius)), strict=True))
