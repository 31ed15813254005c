from __future__ import annotations

import random

import numpy as np
import pytest
from brute import contamination

from loamsift.llm import _common as C
from loamsift.llm import decontaminate as D


def tables(spark, docs_of, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "é", "D1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([0, 1, 2, 9, 10, 11, 14, 30])] + [(4, "zz"), (None, "null item words"), (11, None), (12, "a" if seed else "b")]
    rows = [(i, "; ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 12, 40])))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "x " + items[7][1].upper() + " y"), (103, "null, item words!"), (103, "null, item words!"), (None, "zz"), (104, "q " * 30_000 + items[5][1])]
    return rows, items, docs_of(rows, extra=True), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 20, 60])
@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(spark, docs_of, seed, block):
    rows, items, docs, bench = tables(spark, docs_of, seed)
    want = contamination(rows, items)
    assert sorted((tuple(r) for r in D.digest(D.contamination(docs, bench, block_bytes=block)).collect()), key=repr) == want
    kept = D.decontaminate(docs, bench, block_bytes=block)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((w[0] for w in want if not w[5]), key=repr)
    assert kept.columns == docs.columns


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.digest(D.contamination(docs_of([(1, "a")]), none)).first().n_hit == 0
    assert D.decontaminate(docs_of([]), none).count() == 0


def shard(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return D.SuffixArray(C.Words(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])])))


def test_suffix_array_order_and_longest_matches():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["a", "b", "c"], 60)) for _ in range(5)]
    texts += [texts[0], "a " * 90, ""]
    array = shard(texts)
    heads = [tuple(array.text[i:]) for i in array.order]
    assert heads == sorted(heads) and sorted(array.order) == list(range(array.n))
    block = D.TestBlock.of([(1, "a b b c a q a b"), (2, texts[2]), (3, "a " * 50)])
    at = np.flatnonzero(block.known)
    got = array.longest(array.symbols(block), at, block.known[at])
    own = [t.split() for t in texts]
    tests = [w[i:] for w in ("a b b c a q a b".split(), own[2], ["a"] * 50) for i in range(len(w))]
    for w, n in zip(tests, got, strict=True):
        assert n == max((k for k in range(1, len(w) + 1) if any(o[i : i + k] == w[:k] for o in own for i in range(len(o)))), default=0)


def test_longest_match_has_no_bound(spark, docs_of):
    """A match of 300 words has its length and place, and the item it is from."""
    rng = random.Random(3)
    item = [f"w{rng.randrange(10_000)}" for _ in range(300)]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(item[50:80]))], "item_id long, text string")
    rows = [(1, " ".join(["x"] * 20 + item + ["y"] * 5)), (2, " ".join(item[40:90])), (3, "x y")]
    got = {r.doc_id: r.longest for r in D.contamination(docs_of(rows), bench, block_bytes=100).collect()}
    assert (got[1].words, got[1].at, got[1]["item"]) == (300, 20, "7") and (got[2].words, got[2].at, got[2]["item"]) == (50, 0, "7") and got[3] is None
