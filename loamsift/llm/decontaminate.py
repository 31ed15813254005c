"""Benchmark decontamination with suffix arrays of the training texts.

Each shard (a few megabytes of documents) is a sequence of word symbols, closed by a separator of its own after each document. Its
suffix array is complete: prefix doubling goes on, over what is still tied, until no two suffixes are. Every suffix of every test item is binary-searched in every shard: the
neighbours give its longest verbatim match there, and where that reaches a window, the array's interval lists all its places, from each of which the match is
followed to its end. A shard's array is built once; test items stream through it in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.llm import _common as C

WINDOW_WORDS = 10
SHARD_BYTES = 3 << 20
#: Symbols compared at once.
STEP = 16
BLOCK_BYTES = 8 << 20
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@dataclass
class TestBlock:
    """Words of test items as hashes, a closer after each item; for each place the words left in its item (``known``, 0 for closers), the item, and the length of its window."""

    hashes: np.ndarray
    known: np.ndarray
    item: np.ndarray
    need: np.ndarray
    ids: list[str | None]

    @staticmethod
    def of(items: list[tuple[object, str]], window: int = WINDOW_WORDS) -> TestBlock:
        hashes, known, owner, need, ids = [], [], [], [], []
        for item_id, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            h = C.Words(raw, np.array([0, len(raw)])).hash
            if not len(h):
                continue
            hashes += [h, np.zeros(1, np.uint64)]
            known.append(np.arange(len(h), -1, -1))
            owner.append(np.full(len(h) + 1, len(ids)))
            need.append(np.full(len(h) + 1, min(window, len(h))))
            ids.append(None if item_id is None else str(item_id))
        whole = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return TestBlock(whole(hashes, np.uint64), whole(known, np.int64), whole(owner, np.int64), whole(need, np.int64), ids)


class SuffixArray:
    """All suffixes of the documents of a shard, in order."""

    def __init__(self, words: C.Words):
        self.vocabulary, symbol = np.unique(words.hash, return_inverse=True)
        rows = len(words.first) - 1
        self.n = n = len(words) + rows
        self.text = np.empty(n, np.int64)
        self.at = np.arange(len(words)) + words.row()  # where each word stands in text
        self.text[self.at] = symbol
        self.text[words.first[1:] + np.arange(rows)] = len(self.vocabulary) + np.arange(rows)
        self.padded = np.concatenate([self.text, np.full(STEP, -1)])
        self.order = np.argsort(self.text, kind="stable")
        # A suffix's rank is the first place of those it is tied with; only tied ones are sorted again.
        head = np.concatenate([[True], self.text[self.order][1:] != self.text[self.order][:-1]]) if n else np.zeros(0, bool)
        rank = np.empty(n + 1, np.int64)
        rank[n] = -1
        rank[self.order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        tied, k = np.flatnonzero(~(head & np.append(head[1:], True))), 1
        while len(tied):
            who = self.order[tied]
            key = rank[who] * np.int64(n + 1) + rank[np.minimum(who + k, n)] + 1
            by = np.argsort(key, kind="stable")
            who, key = who[by], key[by]
            self.order[tied] = who
            head = np.concatenate([[True], key[1:] != key[:-1]])
            rank[who] = tied[np.maximum.accumulate(np.where(head, np.arange(len(who)), 0))]
            tied, k = tied[~(head & np.append(head[1:], True))], k * 2

    def symbols(self, block: TestBlock) -> np.ndarray:
        """Symbols of a block's words: -2 where the shard doesn't have the word, and for closers."""
        if not len(self.vocabulary):
            return np.full(len(block.hashes), -2)
        at = np.minimum(np.searchsorted(self.vocabulary, block.hashes), len(self.vocabulary) - 1)
        return np.where((self.vocabulary[at] == block.hashes) & (block.known > 0), at, -2)

    def matched(self, query: np.ndarray, start: np.ndarray, known: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(matching symbols, whether the suffix at ``place`` is less) for the suffixes of ``query`` from ``start`` on, of which only the first ``known`` symbols count."""
        first, less = np.zeros(len(start), np.int64), np.zeros(len(start), bool)
        open_ = np.arange(len(start))
        while len(open_):
            step = first[open_][:, None] + np.arange(STEP)
            own = self.padded[np.minimum(place[open_][:, None] + step, self.n)]
            asked = query[np.minimum(start[open_][:, None] + step, len(query) - 1)]
            ends = step >= known[open_][:, None]
            stop = (own != asked) | ends
            at = np.where(stop.any(1), stop.argmax(1), STEP)
            line, safe = np.arange(len(open_)), np.minimum(at, STEP - 1)
            done = at < STEP
            less[open_[done]] = ((own[line, safe] < asked[line, safe]) & ~ends[line, safe])[done]
            first[open_] += at
            open_ = open_[~done]
        return first, less

    def bound(self, query: np.ndarray, start: np.ndarray, known: np.ndarray, upper: bool) -> np.ndarray:
        """Binary search of all suffixes of the query at once."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.n, np.int64)
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            first, less = self.matched(query, start[open_], known[open_], self.order[mid])
            right = less | (upper & (first >= known[open_]))
            lo[open_[right]], hi[open_[~right]] = mid[right] + 1, mid[~right]
        return lo

    def longest(self, query: np.ndarray, start: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The longest match of each suffix of the query anywhere in the shard."""
        at = self.bound(query, start, known, False)
        best = np.zeros(len(start), np.int64)
        for near in (at - 1, at):
            ok = (near >= 0) & (near < self.n)
            first, _ = self.matched(query, start, known, self.order[np.clip(near, 0, self.n - 1)])
            best = np.maximum(best, np.where(ok, first, 0))
        return best


@dataclass
class Found:
    """Occurrences of windows: the word of the shard where each begins, its length, that of the whole match from there, and the item."""

    place: np.ndarray
    length: np.ndarray
    whole: np.ndarray
    item: np.ndarray


def find_in_shard(array: SuffixArray, block: TestBlock) -> Found:
    query = array.symbols(block)
    live = np.flatnonzero((query >= 0) & (block.known >= block.need))
    far = live[array.longest(query, live, block.known[live]) >= block.need[live]] if array.n else live[:0]
    need = block.need[far]
    lo, hi = array.bound(query, far, need, False), array.bound(query, far, need, True)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    at, start = array.order[rank], far[which]
    whole, _ = array.matched(query, start, block.known[start], at)
    return Found(np.searchsorted(array.at, at), need[which], whole, block.item[start])


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list[Broadcast]:
    """The test items in blocks of about ``block_bytes``, dealt by a hash; the driver holds one at a time and the broadcasts are in files."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    out = []
    for b in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        block = TestBlock.of([tuple(r) for r in mine.distinct().orderBy("item_id", "text").collect()], window)
        out.append(benchmark.sparkSession.sparkContext.broadcast(block))
    return out


def _each(shared: list[Broadcast]) -> Iterator[TestBlock]:
    """One block after another; of several, a worker holds no more than one."""
    for b in shared:
        yield b.value
        if len(shared) > 1:
            b.__dict__.pop("_value", None)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document row: doc_id, n_words, spans (first word, word after the last, of each merged run of hit words), items (ids, sorted as strings), longest (words, first
    word and item of the longest verbatim match that reaches a window; of equal ones the first in the document, then the smallest id; null without a hit).

    Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. A test item of fewer words than a window, but not none, is one window. Null
    texts have no words. An item without id counts as a hit but isn't listed; repeated items count once. Repeated document rows each get their row.
    A block of items has ``block_bytes`` at most, or one item.
    """
    shared = _blocks(benchmark, window, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=SHARD_BYTES):
            n = batch.num_rows
            words = C.Words(*C.string_bytes(batch.column("text")))
            array, row = SuffixArray(words), words.row()
            cover = np.zeros(len(words) + 1, np.int64)
            found: list[set] = [set() for _ in range(n)]
            best: list[tuple | None] = [None] * n
            for block in _each(shared):
                got = find_in_shard(array, block)
                np.add.at(cover, got.place, 1)
                np.add.at(cover, got.place + got.length, -1)
                own = row[got.place]
                for r, i in set(zip(own.tolist(), got.item.tolist(), strict=True)):
                    if block.ids[i] is not None:
                        found[r].add(block.ids[i])
                names = np.array([x or "" for x in block.ids], object)[got.item] if len(got.item) else got.item
                for x in np.lexsort((names, got.place, -got.whole, own))[np.unique(np.sort(own), return_index=True)[1]]:
                    r, item = int(own[x]), block.ids[int(got.item[x])]
                    new = (-int(got.whole[x]), int(got.place[x]) - int(words.first[r]), item or "", item)
                    best[r] = new if best[r] is None else min(best[r], new, key=lambda t: t[:3])
            hit = np.cumsum(cover[:-1]) > 0
            begins = np.flatnonzero(hit & ~(np.concatenate([[False], hit[:-1] & (row[1:] == row[:-1])]) if len(hit) else hit))
            ends = np.flatnonzero(hit & ~(np.concatenate([hit[1:] & (row[1:] == row[:-1]), [False]]) if len(hit) else hit)) + 1
            spans: list[list] = [[] for _ in range(n)]
            for a, e in zip(begins.tolist(), ends.tolist(), strict=True):
                base = int(words.first[row[a]])
                spans[row[a]].append([a - base, e - base])
            longest = [None if b is None else {"words": -b[0], "at": b[1], "item": b[3]} for b in best]
            cols = [batch.column("doc_id"), pa.array(np.diff(words.first), pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array([sorted(x) for x in found], pa.list_(pa.string())), pa.array(longest, kind)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "spans", "items", "longest"])

    kind = pa.struct([("words", pa.int64()), ("at", pa.int64()), ("item", pa.string())])
    return C.keyed_rows(docs).mapInArrow(run, "doc_id long, n_words long, spans array<array<long>>, items array<string>, longest struct<words: long, at: long, item: string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a window of a test item; all columns stay, and no row moves. A null or empty text holds none and stays."""
    shared = _blocks(benchmark, window, block_bytes)

    def change(batch: pa.RecordBatch, raw: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
        words = C.Words(raw, offs)
        array, row, clean = SuffixArray(words), words.row(), np.ones(batch.num_rows, bool)
        for block in _each(shared):
            clean[row[find_in_shard(array, block).place]] = False
        return batch.filter(pa.array(clean))

    return C.passing(docs, "text", change)


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x[1] - x[0])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
                        F.coalesce("longest.words", F.lit(0)).alias("longest_match"), F.col("longest.at").alias("longest_at"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark")))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
lens AS (SELECT DISTINCT least(len(w), 10) AS k FROM b WHERE len(w) > 0),
bj AS (SELECT item_id, i AS j, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
bw AS (SELECT DISTINCT item_id, k, g FROM bj),
dw AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens WHERE len(w) >= k)),
hits AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id),
isl AS (SELECT dw.doc_id, bj.item_id, dw.i, k, dw.i - bj.j AS diagonal, dw.i - row_number() OVER (PARTITION BY dw.doc_id, bj.item_id, dw.i - bj.j ORDER BY dw.i) AS run FROM dw JOIN bj USING (k, g)),
match AS (SELECT doc_id, min(i) - 1 AS a, max(i) - min(i) + any_value(k) AS n FROM isl GROUP BY doc_id, item_id, diagonal, run),
best AS (SELECT doc_id, n, a FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, a) AS r FROM match) WHERE r = 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(best.n, 0)::BIGINT AS longest_match, best.a::BIGINT AS longest_at FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN best USING (doc_id)
"""
