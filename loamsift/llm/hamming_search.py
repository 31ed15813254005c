"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Rotations learned on a bounded sample (iterative quantisation) turn a vector into signs. A code of b bits is split into m substrings with an
index each; if two codes differ in at most r bits, then in some substring they differ in at most r // m, so probing the substring values that near
retrieves every code within r. Those are reranked by the inner product of the original vectors, in double precision.

The radius is measured, not guessed: a few pilot queries are answered exactly over all rows, and r is that distance within which
``TARGET`` of their true neighbours' codes lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamsift.llm import _common as C

NEIGHBOURS = 20
EVERY = 20
SUBSTRING_BITS = 8
ROTATIONS = 2
SAMPLE_ROWS = 8_192
PILOT_QUERIES = 128
TARGET = 0.98
CHUNK_ROWS = 8_192
QUERY_BLOCK = 8_192
ITERATIONS = 20

_NEAR = np.array([[(a ^ b).bit_count() for b in range(256)] for a in range(256)], np.uint8)


@dataclass
class Coder:
    """rotations: (number, width, width); scale: the largest norm, to which all vectors are extended by one component."""

    rotations: np.ndarray
    scale: float

    def extended(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.scale**2 - (x**2).sum(1), 0.0))
        return np.concatenate([x, rest[:, None]], 1)

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Bytes of sign bits. A query has no extension: with it, angles order as inner products do."""
        y = np.concatenate([x, np.zeros((len(x), 1))], 1) if query else self.extended(x)
        return np.concatenate([np.packbits(y @ r > 0, axis=1) for r in self.rotations], 1)


def learn_rotations(sample: np.ndarray, number: int = ROTATIONS, seed: int = 3) -> np.ndarray:
    """Orthogonal matrices that bring the sample near the corners of a cube, each from a start of its own."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    out = []
    for _ in range(number):
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(ITERATIONS if len(sample) else 0):
            u, _, vt = np.linalg.svd(np.sign(sample @ r).T @ sample)
            r = vt.T @ u.T
        out.append(r)
    return np.array(out)


class MultiIndex:
    """An index over byte codes: for each byte, the rows in order of its value."""

    def __init__(self, codes: np.ndarray):
        self.codes, (self.n, self.m) = codes, codes.shape
        pad = (-self.m) % 8
        self.wide = np.ascontiguousarray(np.pad(codes, ((0, 0), (0, pad)))).view(np.uint64)
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(self.m)]
        self.begin = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(queries, rows, distances) of all pairs with a distance of at most ``radius``, each pair once.

        Queries with one value in a substring share its probes; a pair is given by the first substring near enough.
        """
        each = radius // self.m
        pad = (-self.m) % 8
        wide = np.ascontiguousarray(np.pad(queries, ((0, 0), (0, pad)))).view(np.uint64)
        for j in range(self.m):
            for value in np.unique(queries[:, j]):
                own = np.flatnonzero(queries[:, j] == value)
                near = np.flatnonzero(_NEAR[value] <= each)
                rows = np.concatenate([self.order[j][self.begin[j][v] : self.begin[j][v + 1]] for v in near]) if len(near) else own[:0]
                if not len(rows):
                    continue
                apart = np.zeros((len(own), len(rows)), np.uint16)
                for w in range(wide.shape[1]):
                    apart += np.bitwise_count(wide[own, w][:, None] ^ self.wide[rows, w][None, :])
                q, r = np.nonzero(apart <= radius)
                q_, r_ = own[q], rows[r]
                fresh = np.ones(len(q), bool)
                for i in range(j):
                    fresh &= _NEAR[queries[q_, i], self.codes[r_, i]] > each
                yield q_[fresh], r_[fresh], apart[q[fresh], r[fresh]]


def top(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: largest score first, then smallest id."""
    order = np.lexsort((ids, -score, query))
    rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    return order[rank < k]


class Chunk:
    """A chunk of rows with its index. Of equal vectors only those of the k smallest ids can be among the k nearest, so the others aren't indexed."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, coder: Coder, k: int):
        _, same = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
        order = np.lexsort((ids, same))
        rank = np.arange(len(order)) - np.searchsorted(same[order], same[order])
        keep = order[rank < k]
        self.ids, self.x, self.coder, self.k = ids[keep], x[keep], coder, k
        self.index = MultiIndex(coder.codes(self.x))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vec_id, score): the k nearest found. A query with fewer than k rows within the radius gets the radius widened, so a small table is answered in full."""
        codes = self.coder.codes(queries, query=True)
        open_, found, bits = np.arange(len(queries)), [], self.index.m * 8
        want = min(self.k, len(self.ids))
        while len(open_):
            got = [(open_[q], r) for q, r, _ in self.index.within(codes[open_], radius)]
            q = np.concatenate([a for a, _ in got]) if got else open_[:0]
            r = np.concatenate([b for _, b in got]) if got else open_[:0]
            full = np.bincount(q, minlength=len(queries)) >= want
            ready = full[q]
            q, r = q[ready], r[ready]
            for a in range(0, len(q), 1 << 19):  # the rerank takes bounded memory
                part = slice(a, a + (1 << 19))
                found.append((q[part], self.ids[r[part]], (self.x[r[part]] * queries[q[part]]).sum(1)))
            open_ = open_[~full[open_]]
            radius = min(bits, radius + self.index.m)
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        q, i, s = (np.concatenate(z) for z in zip(*found, strict=True))
        best = top(q, i, s, self.k)
        return q[best], i[best], s[best]


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vec): vectors in double precision, without null, zero and non-finite ones."""
    vec = F.col("embedding").cast("array<double>")
    fine = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))) & F.exists(vec, lambda v: v != 0)
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id IS NOT NULL")
    return own.where(F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def _against_all(vectors: DataFrame, k: int, answer: Callable[[np.ndarray, np.ndarray], Iterator[tuple]]) -> DataFrame:
    """(query, rank, vec_id, score): the k best of what ``answer(ids, x)`` gives for each chunk of rows, as (query, vec_id, score) arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            for q, i, s in answer(t.column("vec_id").to_numpy(), _matrix(t.column("vec").chunk(0))):
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["query", "vec_id", "score"])

        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK_ROWS):
                held.append(batch.slice(a, CHUNK_ROWS))
                if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                    yield from done()
                    held.clear()
        if held:
            yield from done()

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return vectors.mapInArrow(run, "query long, vec_id long, score double").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def exact(queries: np.ndarray, k: int) -> Callable[[np.ndarray, np.ndarray], Iterator[tuple]]:
    """Answers by all inner products, for a few queries."""

    def answer(ids: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
        for j, v in enumerate(queries):
            s = (x * v).sum(1)
            best = np.lexsort((ids, -s))[:k]
            yield np.full(len(best), j), ids[best], s[best]

    return answer


def fit(vectors: DataFrame, k: int = NEIGHBOURS) -> tuple[Coder, int]:
    """Rotations and radius for vectors of one width, of which there is one at least. The sample and the pilots are the rows of the smallest hashes, so the same at every run."""
    n, scale = vectors.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)))).first()
    order = F.xxhash64("vec_id")
    share = min(1.0, 2.0 * SAMPLE_ROWS / n)
    drawn = vectors.where(F.pmod(order, F.lit(1 << 20)) < share * (1 << 20)).orderBy(order, "vec_id").limit(SAMPLE_ROWS)
    sample = np.array([r[0] for r in drawn.select("vec").collect()], np.float64)
    if not len(sample):
        sample = np.array([r[0] for r in vectors.select("vec").limit(SAMPLE_ROWS).collect()], np.float64)
    coder = Coder(np.zeros(0), float(scale))
    coder.rotations = learn_rotations(coder.extended(sample))
    pilots = sample[:PILOT_QUERIES]
    near = _against_all(vectors, k + 1, exact(pilots, k + 1)).join(vectors, "vec_id").select("query", "vec").collect()
    a = coder.codes(pilots, query=True)[[r[0] for r in near]]
    b = coder.codes(np.array([r[1] for r in near], np.float64))
    apart = np.bitwise_count(a ^ b).sum(1)
    return coder, int(np.ceil(np.quantile(apart, TARGET)))


@dataclass
class QueryBlock:
    """ids of queries; their distinct vectors; which of these each has."""

    ids: np.ndarray
    distinct: np.ndarray
    which: np.ndarray


def _query_blocks(asked: DataFrame, block: int) -> list[Broadcast]:
    """The queries in blocks of about ``block``, chosen by a hash; the driver holds one at a time and the broadcasts are in files."""
    blocks = max(1, -(-asked.count() // block))
    out = []
    for b in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).groupBy("vec_id").agg(F.min("vec").alias("vec")).collect()
        if got:
            distinct, which = np.unique(np.array([r[1] for r in got], np.float64), axis=0, return_inverse=True)
            out.append(asked.sparkSession.sparkContext.broadcast(QueryBlock(np.array([r[0] for r in got], np.int64), distinct, which.ravel())))
    return out


def _near(shared: list[Broadcast], coder: Coder, radius: int, k: int) -> Callable[[np.ndarray, np.ndarray], Iterator[tuple]]:
    """Answers through the index of a chunk, which is built once for all blocks of queries."""

    def answer(ids: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
        chunk = Chunk(ids, x, coder, k + 1)
        for b in shared:
            own = b.value
            q, i, s = chunk.search(own.distinct, radius)
            order = np.argsort(q, kind="stable")
            low, high = (np.searchsorted(q[order], own.which, side) for side in ("left", "right"))
            n = high - low
            at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
            query = np.repeat(own.ids, n)
            other = i[at] != query
            yield query[other], i[at][other], s[at][other]
            if len(shared) > 1:  # a worker holds one block at a time
                b.__dict__.pop("_value", None)

    return answer


def search(rows: DataFrame, k: int = NEIGHBOURS, every: int = EVERY, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): queries are rows whose vec_id is divisible by ``every``, candidates all rows but the query's own.

    Null, zero and non-finite vectors and rows without vec_id take no part. Vectors of different widths have no inner product, so each width is searched by itself, and
    a width with few rows is answered in full. Ties go to the smaller vec_id. Queries go out in blocks of about ``block`` and meet every chunk of rows in one pass. A repeated vec_id is
    a row of its own as a candidate; as a query its first vector (of a width) counts, and no row of that id answers it.
    """
    spark = rows.sparkSession
    C.bound_batches(spark)
    vectors = usable(rows)
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for (width,) in sorted(vectors.select(F.size("vec")).distinct().collect()):
        found = _search(vectors.where(F.size("vec") == width), k, every, block)
        out = found if out.isEmpty() else out.unionByName(found)
    return out


def _search(vectors: DataFrame, k: int, every: int, block: int) -> DataFrame:
    coder, radius = fit(vectors, k)
    shared = _query_blocks(vectors.where(F.col("vec_id") % every == 0), block)
    dealt = vectors.repartition(max(1, -(-vectors.count() // CHUNK_ROWS)))
    return _against_all(dealt, k, _near(shared, coder, radius, k)).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def op6_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(C.table(spark, sf_dir, "embeddings"))
