"""Near-duplicate documents by MinHash, banded buckets, true Jaccard similarity and connected components.

Rows with equal shingle sets are one class, for which its smallest id stands, before anything is paired: exact copies and empty
texts, which share every band, cost a row each. Components need no list of all pairs: buckets over ``star_from`` classes are linked by
stars, and what those leave apart is compared in full, so the result is that of all pairs. ``max_bucket`` skips larger buckets and
``max_words`` cuts texts, as the surveyed scripts do; both lose duplicates, and neither is on unless asked for.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha1

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.functions import minhash, text
from loamsift.operators.components import components
from loamsift.session import bound_batches, materialize


@dataclass(frozen=True)
class Settings:
    num_hashes: int = 256
    num_bands: int = 32
    ngrams: int = 5
    threshold: float = 0.5
    max_bucket: int | None = None
    max_words: int | None = None
    drop_null: bool = True
    star_from: int = 64

    def __post_init__(self) -> None:
        if self.num_hashes % self.num_bands:
            raise ValueError("num_hashes must be a multiple of num_bands")
        if self.max_bucket is not None and self.max_bucket < 2:
            raise ValueError("max_bucket must be at least 2")
        if self.star_from < 2:
            raise ValueError("star_from must be at least 2")

    @property
    def rows(self) -> int:
        return self.num_hashes // self.num_bands


def _body(docs: DataFrame, s: Settings, key: str, column: str) -> DataFrame:
    own = docs.where(F.col(column).isNotNull()) if s.drop_null else docs.withColumn(column, F.coalesce(column, F.lit("")))
    return own.select(F.col(key).cast("long").alias("id"), (text.truncate_words(F.col(column), s.max_words) if s.max_words else F.col(column)).alias("t"))


def shingled(docs: DataFrame, s: Settings, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, shingles): of the normalised text, which is cut to ``max_words`` first. Null texts are left out, or empty."""
    cut = _body(docs, s, key, column).select("id", text.normalized_words(F.col("t")).alias("w"))
    return cut.select("id", text.word_ngrams(F.col("w"), s.ngrams).alias("shingles"))


#: Bytes of normalised text whose signatures are computed together.
SLICE_BYTES = 1 << 19


def _shingle_numbers(normal: str, n: int) -> np.ndarray:
    """Sorted distinct numbers of the word n-grams of a normalised text: each is a stretch of its bytes, from a word's start to the end of the n-th from there."""
    raw = normal.encode()
    blanks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    start, end = np.concatenate([[0], blanks + 1]), np.append(blanks, len(raw))
    if not raw:
        return np.zeros(0, np.uint64)
    last = max(len(start) - n + 1, 1)
    own = {raw[i:j] for i, j in zip(start[:last].tolist(), end[min(n, len(end)) - 1 :].tolist(), strict=True)}
    return np.sort(np.frombuffer(b"".join([sha1(g).digest()[:8] for g in own]), "<u8"))


def _by_slices(batches: Iterator[pa.RecordBatch], n: int, make: Callable[[list, list[np.ndarray]], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``make(ids, sets)`` for bounded slices of texts (id, t), a set being _shingle_numbers of its text."""
    for batch in batches:
        ids, sets, size = [], [], 0
        for i, t in zip(batch.column("id").to_pylist(), batch.column("t"), strict=True):
            normal = text.normalize_text(t.as_py())
            ids.append(i)
            sets.append(_shingle_numbers(normal, n))
            size += len(normal)
            if size > SLICE_BYTES:
                yield make(ids, sets)
                ids, sets, size = [], [], 0
        if ids:
            yield make(ids, sets)


def _mixed(x: np.ndarray, odd: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(odd)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(odd)
    return x ^ (x >> np.uint64(32))


def signed(docs: DataFrame, s: Settings, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, n, s1, s2, keys): the number of shingles, two sums that name their set, and a 64-bit hash of each band of their MinHash signature.

    Neither shingles nor signatures are kept: of most documents no more than the keys is ever asked for.
    """
    family = minhash.hash_family(s.num_hashes)

    def make(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        first = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
        flat = np.concatenate(sets)
        values = minhash.signature_rows(flat, first, family).reshape(len(ids), s.num_bands, s.rows)
        keys = np.zeros((len(ids), s.num_bands), np.uint64)
        for j in range(s.rows):
            keys = _mixed(keys * np.uint64(0xD6E8FEB86659FD93) + values[:, :, j], 0x9E3779B97F4A7C15)
        sums = []
        for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(flat, odd))])
            sums.append(pa.array((total[first[1:]] - total[first[:-1]]).view(np.int64)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * s.num_bands, pa.int32()), pa.array(keys.view(np.int64).ravel()))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.diff(first)), *sums, lists], names=["id", "n", "s1", "s2", "keys"])

    return _body(docs, s, key, column).mapInArrow(lambda it: _by_slices(it, s.ngrams, make), "id long, n long, s1 long, s2 long, keys array<long>")


def numbered(bodies: DataFrame, s: Settings) -> DataFrame:
    """(id, numbers) of (id, t): the shingles as sorted 64-bit numbers. Two shingles of one pair of documents share one with a chance of about 2^-64."""

    def make(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["id", "numbers"])

    return bodies.mapInArrow(lambda it: _by_slices(it, s.ngrams, make), "id long, numbers array<long>")


def shingle_counts(docs: DataFrame, s: Settings, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(number, n): each shingle number, as a signed 64-bit one, and how often documents hold it. No text's shingles leave their task as strings."""
    bound_batches(docs.sparkSession)

    def make(_: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        own, n = np.unique(np.concatenate(sets), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n.astype(np.int64))], names=["number", "n"])

    counted = _body(docs, s, key, column).mapInArrow(lambda it: _by_slices(it, s.ngrams, make), "number long, n long")
    return counted.groupBy("number").agg(F.sum("n").alias("n"))


def classes(signed: DataFrame) -> DataFrame:
    """(id, rep): rep is the smallest id with an equal set, which two sums and its size name."""
    named = signed.select("id", "s1", "s2", "n")
    return named.join(named.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep")), ["s1", "s2", "n"]).select("id", "rep")


def band_keys(signed: DataFrame) -> DataFrame:
    """(id, band, key) for each band; pairs are verified whatever brought them together."""
    return signed.select("id", F.posexplode("keys").alias("band", "key"))


def buckets(keys: DataFrame) -> DataFrame:
    return keys.groupBy("band", "key").agg(F.count("*").alias("size"))


def _in_buckets(keys: DataFrame, s: Settings, low: int, high: int | None = None) -> DataFrame:
    """``keys`` of buckets of ``low`` to ``high`` classes, without those that max_bucket skips."""
    sized = buckets(keys).where(F.col("size") >= low)
    for most in (high, s.max_bucket):
        if most is not None:
            sized = sized.where(F.col("size") <= most)
    return keys.join(sized.select("band", "key"), ["band", "key"], "left_semi")


def candidates(keys: DataFrame, s: Settings, most: int | None = None) -> DataFrame:
    """(a, b, bands): pairs a < b that share a bucket (of at most ``most`` classes), and how many they share."""
    kept = _in_buckets(keys, s, 2, most)
    left, right = kept.withColumnRenamed("id", "a"), kept.withColumnRenamed("id", "b")
    return left.join(right, ["band", "key"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("bands"))


def jaccard(x: Column, y: Column) -> Column:
    """Of two arrays without repeats; two empty ones are alike, an empty and another are not."""
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).otherwise(both.cast("double") / (F.size(x) + F.size(y) - both))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, bands, jaccard) of pairs that reach the threshold."""
    first = sets.select(F.col("id").alias("a"), F.col("numbers").alias("_x"))
    second = sets.select(F.col("id").alias("b"), F.col("numbers").alias("_y"))
    scored = pairs.join(first, "a").join(second, "b").withColumn("jaccard", jaccard(F.col("_x"), F.col("_y")))
    return scored.where(F.col("jaccard") >= threshold).drop("_x", "_y")


def _unsettled(large: DataFrame, edges: DataFrame) -> DataFrame:
    """(band, key, id, component, main): the members of buckets that still hold several components, of which main is the commonest."""
    tagged = large.join(components(edges).withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    parts = tagged.groupBy("band", "key", "component").agg(F.count("*").alias("_n"))
    main = parts.groupBy("band", "key").agg(F.count("*").alias("_parts"), F.max_by("component", F.struct("_n", "component")).alias("main")).where("_parts > 1")
    return materialize(tagged.join(main.drop("_parts"), ["band", "key"]))


def links(large: DataFrame, edges: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``edges`` (u, v) and as many verified pairs within the buckets ``large`` as give the components that all of them would give.

    In each round every member outside a bucket's main component is compared with one hub inside it. Once a round settles less than half
    of those members, each is compared with all members of the other components, after which no pair of a bucket is open.
    """
    before, turn, last = None, 0, False
    while not last:
        members = _unsettled(large, edges)
        rest = members.where("component <> main").select("band", "key", F.col("id").alias("_own"), F.col("component").alias("_part"))
        number = rest.count()
        if not number:
            break
        last = before is not None and 2 * number > before
        if last:
            others = members.select("band", "key", F.col("id").alias("_other"), F.col("component").alias("_apart"))
            met = rest.join(others, ["band", "key"]).where("_part <> _apart")
        else:
            hubs = members.where("component = main").groupBy("band", "key").agg(F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("_other"))
            met = rest.join(hubs, ["band", "key"])
        pairs = met.select(F.least("_own", "_other").alias("a"), F.greatest("_own", "_other").alias("b")).distinct()
        found = verified(pairs, sets, threshold).select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = materialize(edges.unionByName(found))
        before, turn = number, turn + 1
    return edges


@dataclass
class NearDuplicates:
    """``membership``: (id, rep, component); ``sizes``: (id, n, ...), the number of shingles; ``candidates`` and ``pairs``: all candidate and all verified pairs of class representatives; ``keys``: their buckets.

    ``pairs`` and ``counts`` list pairs, the square of a bucket's classes; ``membership`` and ``keep`` don't.
    """

    membership: DataFrame
    pairs: DataFrame
    keys: DataFrame
    candidates: DataFrame
    sizes: DataFrame
    settings: Settings

    def keep(self) -> DataFrame:
        return self.membership.where("id = component").select("id")

    def skipped_buckets(self) -> DataFrame:
        s = self.settings
        return buckets(self.keys).where(F.col("size") > s.max_bucket) if s.max_bucket else buckets(self.keys).where("false")

    def counts(self) -> DataFrame:
        found = self.candidates.agg(F.count("*").alias("candidate_pairs"), F.coalesce(F.sum("bands"), F.lit(0)).alias("candidate_pairs_by_band"))
        kept = self.membership.agg(F.count("*").alias("documents"), F.count_if(F.col("id") != F.col("component")).alias("removed"))
        return _side_by_side(kept, found, self.pairs.agg(F.count("*").alias("verified_pairs")))


def _side_by_side(*one_row_each: DataFrame) -> DataFrame:
    out = one_row_each[0].withColumn("_one", F.lit(1))
    for other in one_row_each[1:]:
        out = out.join(other.withColumn("_one", F.lit(1)), "_one")
    return out.drop("_one")


def find(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id", column: str = "text") -> NearDuplicates:
    """Signatures once, in a written table; then one shuffle for all bands, and rounds of links and components that each end in a written table."""
    given = materialize(signed(docs, s, key, column))
    member = materialize(classes(given))
    chosen = given.join(member.where("id = rep").select("id"), "id", "left_semi")
    keys = materialize(band_keys(chosen))
    met = materialize(candidates(keys, s, s.star_from))
    large = materialize(_in_buckets(keys, s, s.star_from + 1))
    # Shingles are made again, of those documents only that are compared with another.
    asked = met.select(F.col("a").alias("id")).union(met.select("b")).union(large.select("id")).distinct()
    sets = materialize(numbered(_body(docs, s, key, column).join(asked, "id", "left_semi"), s))
    pairs = materialize(verified(met, sets, s.threshold))
    edges = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not large.isEmpty():
        edges = links(large, edges, sets, s.threshold)
        met = candidates(keys, s)
        pairs = verified(met, sets, s.threshold)
    labels = components(edges)
    joined = member.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return NearDuplicates(joined.select("id", "rep", F.coalesce("component", "rep").alias("component")), pairs, keys, met, given, s)


def files_report(docs: DataFrame, s: Settings = Settings(), file: str = "_file", key: str = "doc_id", column: str = "text") -> DataFrame:
    """(file, rows, kept) of each input file: what a job over a folder reports and, with ``count_only``, all that it does; see folder_job."""
    kept = find(docs, s, key, column).keep().withColumn("_kept", F.lit(1)).withColumnRenamed("id", key)
    return docs.select(file, F.col(key).cast("long").alias(key)).join(kept, key, "left").groupBy(file).agg(F.count("*").alias("rows"), F.count("_kept").alias("kept"))


def totals(found: NearDuplicates) -> DataFrame:
    """One row: counts() with total_shingles, and buckets that max_bucket skipped."""
    shingles = found.sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_shingles"))
    return _side_by_side(found.counts(), shingles, found.skipped_buckets().agg(F.count("*").alias("skipped_buckets")))


def folder_job(spark: SparkSession, paths: list[str] | str, out: str | None, s: Settings = Settings(), key: str = "doc_id", column: str = "text", count_only: bool = False) -> dict:
    """Near duplicates over all rows of Parquet files: a dict with rows, kept, removed, kept_by_file and seconds of each step. The kept rows go to ``out``, unless ``count_only``."""
    from loamsift.sources.readers import parquet

    clock, seconds = time.perf_counter(), {}

    def lap(name: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        seconds[name], clock = round(now - clock, 3), now

    docs = parquet(spark, paths, text=column)
    found = materialize(files_report(docs, s, "_file", key, column))
    lap("find")
    rows = found.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("kept"), F.lit(0))).first()
    if not count_only:
        drop_near_duplicates(docs.drop("_file"), s, key, column).write.option("compression", "zstd").parquet(out)
        lap("write")
    return {"rows": rows[0], "kept": rows[1], "removed": rows[0] - rows[1], "kept_by_file": found, "seconds": seconds}


def drop_near_duplicates(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id", column: str = "text") -> DataFrame:
    """``docs`` less all but the smallest id of each component; rows with a null text leave too (see Settings.drop_null)."""
    return docs.join(find(docs, s, key, column).keep().withColumnRenamed("id", key), key, "left_semi")
