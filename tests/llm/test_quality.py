from __future__ import annotations

import math
import zlib

import numpy as np
from brute import nbsvm, quality_features
from pyspark.sql import functions as F

from loamsift.llm import _common as C
from loamsift.llm import quality_nbsvm as Q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.op2_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert got.where("quality = predicted").count() / got.count() > 0.97
    assert got.where("(score >= 0.5) <> (predicted = 1) OR score < 0 OR score > 1").count() == 0


def features(text):
    word = lambda x: int(C.Words(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]), ink=True).hash[0])
    pair = lambda a, b: int(C.grams(np.array([a, b], np.uint64), 2)[0])
    return quality_features(text, Q.DIMENSIONS_LOG2, Q.REPEATS, C.mix, word, pair)


def test_indicators_one_by_one():
    texts = ["", "ab", "The the THE cat\tcat", "é x é x", "a a a a a a a a a a a a b b"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    f, first = Q.indicators(raw, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]))
    for i, t in enumerate(texts):
        assert set(f[first[i] : first[i + 1]].tolist()) == features(t)


def test_scores_match_a_plain_version(spark, sf, sf_tables):
    """Features, log-count ratios, descent and scores of the whole query, written out with sets and loops."""
    docs, labels = {r.doc_id: r.text for r in sf_tables("documents").collect()}, {r.doc_id: r.quality for r in sf_tables("labels").collect()}
    own = {i: features(t) for i, t in docs.items()}
    learn = [i for i in sorted(labels) if labels[i] is not None and i in docs and zlib.crc32(str(i).encode()) % 3 != 1]
    weights, bias = nbsvm([own[i] for i in learn], [1 if labels[i] else -1 for i in learn], Q.SMOOTHING, Q.PENALTY, Q.EPOCHS, 11)
    for r in Q.op2_quality_classifier(spark, sf).collect():
        margin = sum(weights.get(f, 0.0) for f in own[r.doc_id]) / math.sqrt(max(1, len(own[r.doc_id]))) + bias
        assert abs(r.score - 1 / (1 + math.exp(-margin))) < 1e-6 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_only_the_learning_fold_counts(spark, sf):
    rows = Q.training_rows(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).count() == 0


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "word " * 50_000), (3, "word " * 50_000), (None, "x"), (4, "é"), (5, "ab")]
    model = Q.fit([np.array([1, 2]), np.array([3])], np.array([1, -1]))
    out = Q.score(docs_of(rows, extra=True), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in out if r.doc_id in (1, 2)} == {1 / (1 + np.exp(-model.bias))}
    assert Q.keep_good(docs_of(rows, extra=True), model).columns == docs_of(rows, extra=True).columns
    assert Q.score(docs_of([]), model).count() == 0


def test_one_class_and_no_rows(spark, docs_of):
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, quality int")
    model = Q.train(Q.training_rows(docs_of([(1, "a b c"), (2, "d")]), labels))
    assert model.bias < 0
    model = Q.train(Q.training_rows(docs_of([]), labels))
    assert model.bias > 0


def test_descent_reaches_the_dual_optimum():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(40)]
    y = np.where(rng.random(40) < 0.5, 1, -1)
    scale = np.ones(30)
    w, bias = Q.dual_coordinate_descent(rows, y, scale, epochs=400)
    top = {s: len(rows) / (2 * max(1, int((y == s).sum()))) for s in (1, -1)}

    def loss(w, b):
        m = np.array([w[x].sum() / np.sqrt(len(x)) + b for x in rows])
        return 0.5 * (w @ w + b * b) + sum(top[s] * np.maximum(0, 1 - s * m[y == s]).sum() for s in (1, -1))

    best = loss(w, bias)
    assert all(loss(w + rng.normal(0, 0.05, 30), bias + rng.normal(0, 0.05)) >= best - 1e-3 for _ in range(200))
