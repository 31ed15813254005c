"""Language identification with bit-sliced Bloom filters of character n-grams.

One filter of M places serves all languages: a place holds a bit for each language, so an n-gram's k places, read
together and combined by AND, return the mask of all languages that (may) contain it. A text's n-grams are looked up, each language's bits
are counted, and the counts, corrected for the language's false-positive rate, decide.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamsift.llm import _common as C
from loamsift.llm.sampling import bounded_by_class, fold

FOLDS, HELD_OUT = 5, 0
SAMPLE_PER_LANGUAGE = 800
GRAMS_PER_LANGUAGE = 6_000
ORDERS = (2, 3)
#: A language is credited with an n-gram only if its rate there is at least this part of the highest rate of any language.
RATE_SHARE = 0.2
PLACES_LOG2 = 18
HASHES = 3


@functools.cache
def _letters() -> np.ndarray:
    """The lower-case code point of each letter, 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letter_grams(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of n-grams, row of each, whether each row has a letter); words are letters with a gap on either side."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = (raw & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(begins)])[offs]
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    n = len(points) + len(at)
    sym, row = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    place = np.arange(len(points)) + rows + 1
    sym[place], row[place] = _letters()[points], rows
    letter = sym > 0
    has = np.zeros(len(at) - 1, bool)
    has[row[letter]] = True
    out_h, out_r = [], []
    for k in ORDERS:
        ok = np.ones(n - k + 1, bool)
        for j in range(1, k - 1):
            ok &= letter[j : n - k + 1 + j]
        if k == 2:
            ok &= letter[:-1] | letter[1:]
        h = C.grams(sym, k)[ok] + np.uint64(k)
        lead = letter[: n - k + 1][ok]
        r = np.where(lead, row[: n - k + 1][ok], row[1 : n - k + 2][ok])
        out_h.append(h)
        out_r.append(r)
    return np.concatenate(out_h), np.concatenate(out_r), has


@dataclass
class BitSlicedFilter:
    """masks[slice, place]: bits of 64 languages each; fill[lang]: its chance of a false positive."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(languages: list[str], members: dict[str, np.ndarray], log2: int = PLACES_LOG2) -> BitSlicedFilter:
        masks = np.zeros((max(1, -(-len(languages) // 64)), 1 << log2), np.uint64)
        rates = []
        for i, lang in enumerate(languages):
            bit = np.uint64(1) << np.uint64(i % 64)
            for p in places(members[lang], log2):
                masks[i // 64][p] |= bit
            rates.append(float(((masks[i // 64] & bit) > 0).mean()) ** HASHES)
        return BitSlicedFilter(languages, masks, np.array(rates))

    def lookup(self, grams: np.ndarray, part: int = 0) -> np.ndarray:
        """The masks of languages that contain each n-gram."""
        log2 = self.masks.shape[1].bit_length() - 1
        out = None
        for p in places(grams, log2):
            got = self.masks[part][p]
            out = got if out is None else out & got
        return out

    def counts(self, grams: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        """Corrected counts, rows x languages: hits less those expected by chance."""
        total = np.bincount(rows, minlength=n_rows).astype(float)
        out = np.zeros((n_rows, len(self.languages)))
        for part in range(len(self.masks)):
            mask = self.lookup(grams, part)
            for i in range(part * 64, min(len(self.languages), part * 64 + 64)):
                hit = (mask >> np.uint64(i % 64)) & np.uint64(1)
                out[:, i] = np.bincount(rows[hit > 0], minlength=n_rows)
        f = self.false_rate
        return np.maximum(0.0, (out - total[:, None] * f) / (1 - np.minimum(f, 0.999)))


def places(grams: np.ndarray, log2: int) -> Iterator[np.ndarray]:
    """Double hashing: k places for each n-gram."""
    a, b = grams, C.mix(grams + np.uint64(0x51ED270B)) | np.uint64(1)
    for j in range(HASHES):
        yield ((a + np.uint64(j) * b) >> np.uint64(64 - log2)).astype(np.int64)


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, grams: int = GRAMS_PER_LANGUAGE) -> BitSlicedFilter:
    """Fit on (doc_id, text, lang): a sample of at most ``per_language`` rows for each language, each text whole.

    N-grams are counted by Spark; the driver gets at most ``grams`` for each language.
    """
    sample = bounded_by_class(labelled.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang"), "lang", per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=1 << 20):
            langs, which = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            h, r, _ = letter_grams(*C.string_bytes(batch.column("text")))
            for i, lang in enumerate(langs):
                g, n = np.unique(h[which[r] == i], return_counts=True)
                if len(g):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rated = counted.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    rated = rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).where(F.col("rate") >= RATE_SHARE * F.col("top"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = rated.withColumn("rank", rank).where(F.col("rank") <= grams).select("lang", "gram").toPandas()
    members = {k: v.to_numpy(np.int64).view(np.uint64) for k, v in kept.groupby("lang")["gram"]}
    return BitSlicedFilter.build(sorted(members), members)


def predict(docs: DataFrame, model: BitSlicedFilter) -> DataFrame:
    """(doc_id, lang_pred, score) of each row; score is the decided language's part of all corrected counts.

    A null text, or one without a letter, is ``und`` with score 0. If no n-gram is known, the first language in order is
    taken, with score 0; ties go to the first too. Without learned languages all is ``und``. Repeated rows each get their result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in C.slices(batches, limit=1 << 20):
            n = batch.num_rows
            grams, rows, has = letter_grams(*C.string_bytes(batch.column("text")))
            names, score = np.array(["und"] * n, object), np.zeros(n)
            if m.languages:
                got = m.counts(grams, rows, n)
                best, total = got.argmax(1), got.sum(1)
                names = np.where(has, np.array(m.languages, object)[best], "und")
                score = np.where(has & (total > 0), got[np.arange(n), best] / np.maximum(total, 1e-12), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return C.keyed_rows(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    own = C.keyed_rows(docs).select("doc_id", "text")
    learn = docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang")
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return predict(own, train(learn)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
