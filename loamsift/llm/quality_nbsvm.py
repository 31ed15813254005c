"""Quality classifier: naive Bayes support vectors.

N-gram indicators are scaled by the log-count ratios of the two classes, and a linear hinge-loss model over them is fitted by
dual coordinate descent. N-grams are hashed: byte trigrams, words, word pairs, and runs of 2 to ``REPEATS``
equal words whatever the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.llm import _common as C
from loamsift.llm.sampling import bounded_by_class, fold

FOLDS, HELD_OUT = 3, 1
SAMPLE_PER_CLASS = 3_000
DIMENSIONS_LOG2 = 18
SMOOTHING = 1.0
PENALTY = 1.0
EPOCHS = 12
#: Up to so many equal words in a row, each number an indicator of its own.
REPEATS = 10


def indicators(raw: np.ndarray, offs: np.ndarray, log2: int = DIMENSIONS_LOG2) -> tuple[np.ndarray, np.ndarray]:
    """(feature, first place of each row): the distinct hashed n-grams of each text, sorted by row."""
    n_rows, n = len(offs) - 1, len(raw)
    keys = []
    shift = np.uint64(64 - log2)
    if n >= 3:
        wide = raw.astype(np.uint64)
        tri = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
        ok = C.within(offs, 3, n)
        row = np.repeat(np.arange(n_rows), np.diff(offs))[: n - 2]
        keys.append((row[ok].astype(np.uint64) << np.uint64(log2)) | (C.mix(tri[ok] + np.uint64(1)) >> shift))
    w = C.Words(raw, offs, ink=True)
    row = w.row().astype(np.uint64)
    if len(w):
        keys.append((row << np.uint64(log2)) | (C.mix(w.hash + np.uint64(2)) >> shift))
        pair, ok = C.grams(w.hash, 2), C.within(w.first, 2, len(w))
        keys.append((row[: len(pair)][ok] << np.uint64(log2)) | (C.mix(pair[ok] + np.uint64(3)) >> shift))
        run = np.zeros(len(w), bool)  # whether the j words from here on are equal and in one row
        run[: len(ok)] = ok & (w.hash[:-1] == w.hash[1:]) if len(w) > 1 else False
        for j in range(2, REPEATS + 1):
            again = row[run]
            keys.append((again << np.uint64(log2)) | (C.mix(np.full(len(again), j, np.uint64) << np.uint64(32)) >> shift))
            run[:-1] &= run[1:]
            run[-1] = False
    key = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    first = np.searchsorted(key, np.arange(n_rows + 1, dtype=np.uint64) << np.uint64(log2))
    return (key & np.uint64((1 << log2) - 1)).astype(np.int64), first


@dataclass
class NaiveBayesSvm:
    """score = logistic(sum of weights of a text's indicators / root of their number + bias)."""

    weights: np.ndarray
    bias: float

    def margins(self, feature: np.ndarray, first: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.weights[feature])])
        return (total[first[1:]] - total[first[:-1]]) / np.sqrt(np.maximum(np.diff(first), 1)) + self.bias


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, dimensions: int) -> np.ndarray:
    p, q = np.full(dimensions, SMOOTHING), np.full(dimensions, SMOOTHING)
    for x, label in zip(rows, y, strict=True):
        (p if label > 0 else q)[x] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, penalty: float = PENALTY, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """L1-loss linear SVM over x[j] = scale[j] / sqrt(n), with a bias feature of 1; classes weigh alike."""
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    top = {s: penalty * len(rows) / (2 * max(1, int((y == s).sum()))) for s in (1, -1)}
    root = [1 / np.sqrt(max(1, len(x))) for x in rows]
    norm = [float((scale[x] ** 2).sum()) * r * r + 1.0 for x, r in zip(rows, root, strict=True)]
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x, r, s = rows[i], root[i], y[i]
            gradient = s * (float((w[x] * scale[x]).sum()) * r + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), top[s])
            step = (new - alpha[i]) * s
            if step:
                alpha[i] = new
                w[x] += step * r * scale[x]
                bias += step
    return w, bias


def fit(rows: list[np.ndarray], y: np.ndarray, log2: int = DIMENSIONS_LOG2) -> NaiveBayesSvm:
    """Of labels 1 and -1. With one class only, the model always answers it; with none, 1."""
    if len(set(y.tolist())) < 2:
        return NaiveBayesSvm(np.zeros(1 << log2), -1.0 if len(y) and y[0] < 0 else 1.0)
    r = log_count_ratios(rows, y, 1 << log2)
    w, bias = dual_coordinate_descent(rows, y, r)
    return NaiveBayesSvm(w * r, bias)


def train(labelled: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> NaiveBayesSvm:
    """Fit on (doc_id, text, quality): at most ``per_class`` rows of each class, each text whole.

    Indicators are found in parallel; one task fits the model to the bounded sample.
    """
    sample = bounded_by_class(labelled.where(F.col("quality").isin(0, 1)).select("doc_id", "text", "quality"), "quality", per_class)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=1 << 19):
            feature, first = indicators(*C.string_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int64()), C.int_lists(feature, np.diff(first), pa.int32())], names=["doc_id", "quality", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x")
                flat, offs = x.flatten().to_numpy().astype(np.int32), x.offsets.to_numpy() - x.offsets[0].as_py()
                rows = zip(batch.column("doc_id").to_pylist(), batch.column("quality").to_pylist(), offs[:-1], offs[1:], strict=True)
                held += [(doc or 0, q, flat[i:j]) for doc, q, i, j in rows]
        if held:
            held.sort(key=lambda r: (r[0], r[1], r[2][:16].tobytes()))
            model = fit([r[2] for r in held], np.where(np.array([r[1] for r in held]) > 0, 1, -1))
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([float(model.bias)])], names=["weights", "bias"])

    found = sample.mapInArrow(find, "doc_id long, quality long, x array<int>")
    got = found.repartition(1).mapInArrow(learn, "weights binary, bias double").collect()
    if not got:
        return fit([], np.zeros(0, int))
    return NaiveBayesSvm(np.frombuffer(bytes(got[0][0]), np.float64), got[0][1])


def score(docs: DataFrame, model: NaiveBayesSvm) -> DataFrame:
    """(doc_id, score, predicted) of each row. A null or empty text has no indicator: its score is that of the bias alone.

    Repeated rows each get the same result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in C.slices(batches, limit=1 << 19):
            margin = m.margins(*indicators(*C.string_bytes(batch.column("text"))))
            s = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return C.keyed_rows(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents outside the held-out fold. Texts move only for labelled rows that a sample of their size can hold."""
    marked = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    chosen = bounded_by_class(marked.withColumn("text", F.lit("")), "quality", SAMPLE_PER_CLASS).drop("text")
    # The sample has at most SAMPLE_PER_CLASS rows for either class, so its ids can be broadcast.
    return C.keyed_rows(docs).join(F.broadcast(chosen), "doc_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = train(training_rows(docs, C.table(spark, sf_dir, "labels")))
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: NaiveBayesSvm) -> DataFrame:
    """``docs`` without the rows that the model scores under 0.5; all columns stay, and no row moves.

    A null or empty text has the score of the bias alone, like all texts without indicators; repeated rows stay or go together.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def change(batch: pa.RecordBatch, raw: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
        return batch.filter(pa.array(shared.value.margins(*indicators(raw, offs)) >= 0))

    return C.passing(docs, "text", change)
