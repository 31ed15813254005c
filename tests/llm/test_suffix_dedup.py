from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from brute import repeats, without_passages

from loamsift.llm import suffix_dedup as S


def digested(rows):
    return sorted(((i, n, r, s, hashlib.sha256(k).hexdigest(), *rest) for i, n, r, s, k, *rest in rows), key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("aab ") for _ in range(rng.choice([0, 3, 20, 60, 200])))) for i in range(60)]
    return rows + [(60, None), (61, "a" * 300), (62, "é" * 50), (63, "xé" * 40), (5, "a" * 30), (70, rows[4][1]), (71, "long unique " + "z" * 40_000), (72, rows[7][1]), (72, rows[7][1]), (None, rows[9][1])]


@pytest.mark.parametrize(("length", "hot", "shard"), [(12, 2, 300), (12, 10_000, 300), (40, 1, 100), (25, 3, 10_000), (12, 500, 1 << 20)])
def test_against_brute_force(docs_of, length, hot, shard):
    rows = rows_of(length)
    got = S.digest(S.remove_repeats(docs_of(rows, extra=True), length, hot, shard, max(9, length * 3 // 5), 3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == digested(repeats(rows, length, max(9, length * 3 // 5), 3))


def test_whole_table(spark, sf, sf_tables):
    rows = [tuple(r) for r in sf_tables("documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in S.op10_suffix_array_dedup(spark, sf).collect()), key=repr) == digested(repeats(rows, 400, S.PASSAGE_BYTES, S.PASSAGE_WORDS))


def test_passages_of_over_fifty_words_are_caught():
    assert 51 * 5 - 15 == S.PASSAGE_BYTES and S.PASSAGE_WORDS == 51


def test_short_passages(docs_of):
    """A passage of 51 words in fewer than 400 bytes is a passage, not a removed string; the stage takes it out."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 7)))
    passage = " ".join(word() for _ in range(51))
    assert 240 <= len(passage) < 400
    clean = [" ".join(word() for _ in range(80)) for _ in range(6)]
    rows = [(i, f"{c[:90]} {passage} {c[90:]}" if i < 3 else c) for i, c in enumerate(clean)]
    got = {r.doc_id: (r.n_removed, r.n_passages, r.passage_bytes) for r in S.digest(S.remove_repeats(docs_of(rows))).collect()}
    assert all(got[i][:2] == (0, 1) and got[i][2] >= len(passage) for i in range(3)) and all(got[i] == (0, 0, 0) for i in range(3, 6))
    kept = {r.doc_id: r.text for r in S.deduplicate(docs_of(rows)).collect()}
    assert all(passage not in kept[i] for i in range(3)) and all(kept[i] == clean[i] for i in range(3, 6))


def test_stage_form(docs_of):
    rows = [(1, "unrelated!" + "repeated string é here"), (2, "repeated string é here" + "y" * 5), (3, None), (4, "short")]
    df = docs_of(rows, extra=True)
    out = S.deduplicate(df, 12, 9, 99)
    assert out.columns == df.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {1: ("unrelated!", 10), 2: ("y" * 5, 5), 3: (None, None), 4: ("short", 5)}
    assert S.deduplicate(docs_of([]), 12, 9).count() == 0


@pytest.mark.parametrize(("length", "words"), [(12, 99), (40, 4)])
def test_stage_form_against_brute_force(docs_of, length, words):
    rows = [r for r in rows_of(length + 1) if r[0] is not None]
    got = sorted(((r.doc_id, r.text or "") for r in S.deduplicate(docs_of(rows, extra=True), length, max(9, length * 3 // 5), words).collect()), key=repr)
    assert got == sorted(((i, k.decode("utf-8", "ignore")) for i, k in without_passages(rows, length, max(9, length * 3 // 5), words)), key=repr)


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_transform_merge_gives_order_and_common_prefixes():
    rng = random.Random(0)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))).encode() for _ in range(9)]
    shards = [texts[:3], texts[3:4], texts[4:]]
    source, rank, lcp = S.merge_transforms([S.transform(s) for s in shards], 8)
    own = []
    for s in shards:
        suffixes = [(t[p:], i) for i, t in enumerate(s) for p in range(len(t) + 1)]
        own.append([x for x, _ in sorted(suffixes, key=lambda x: ([c + 1 for c in x[0]] + [0], x[1]))])
    merged = [own[s][r] for s, r in zip(source, rank, strict=True)]
    assert sorted(zip(source.tolist(), rank.tolist(), strict=True)) == [(s, r) for s in range(3) for r in range(len(own[s]))]
    for a, b, n in zip(merged, merged[1:], lcp[1:], strict=False):
        assert a[:8] <= b[:8] and n == min(common(a, b), 8)


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 50, 101, dtype=np.uint64)
    for w in (1, 2, 7, 100, 101, 102):
        assert S.sliding_minimum(x, w).tolist() == [int(x[p : p + w].min()) for p in range(max(0, len(x) - w + 1))]
