"""N-gram Jaccard join: a blocked sparse matrix product of the documents' n-gram incidence.

1. A document's set is the hashes of its distinct word n-grams. Equal sets are one class, which has a number of its own and the text of one row; all that follows works on classes, so a doc_id
   may repeat.
2. Bounds by size: if two sets reach the threshold t, they share one of the first n - ceil(t n) + 1 n-grams of each in any common order. Rare n-grams come
   first (by a sketch of counts of fixed size over all documents), so common passages are not in these prefixes. Documents that share a prefix n-gram and whose sizes allow the
   threshold are joined in stars; no pair across connected components of those can reach t.
3. Within a component, parity bits of the sets (an odd sketch) bound every overlap from above. Pairs whose bits don't allow t are discarded; components of the rest are the blocks.
4. Each block (or pair of parts, if a block is large) multiplies its incidence with its transpose, which counts every overlap, discards the pairs
   below the bound that their sizes give, and returns links enough to connect what is linked.
5. Components of the links, named by the smallest doc_id of their classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.llm import _common as C
from loamsift.operators.components import components

WORDS = 5
PERCENT = 75
SKETCH_LOG2 = 20
SKETCH_CHUNK = 1 << 14
#: Documents (estimated from the sketch) under one n-gram, from which it is dealt out by a salt.
HOT_GRAM = 20_000
BLOCK_DOCUMENTS = 1_024
BLOCK_GRAMS = 1 << 20
BITS_DOCUMENTS = 4_096
BITS_BYTES = 8 << 20
#: A dense column costs so many times less for each pair of rows than a sparse one for each pair of entries.
DENSE_RATIO = 100
PAIRS_AT_ONCE = 1 << 20
BROADCAST_ROWS = 150_000
SLICE = 1 << 20


def shingle_sets(raw: np.ndarray, offs: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first place of each row): distinct n-grams, sorted; a shorter text is one n-gram, a text without words has none."""
    w = C.Words(raw, offs, ink=True)
    count = np.diff(w.first)
    g, ok, row = C.grams(w.hash, k), C.within(w.first, k, len(w)), w.row()
    g, row = g[ok], row[: len(ok)][ok]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.array([C.grams(w.hash[w.first[r] : w.first[r + 1]], int(count[r]))[0] + np.uint64(count[r]) for r in short], np.uint64)
        g, row = np.concatenate([g, extra]), np.concatenate([row, short])
    order = np.argsort(g)
    order = order[np.argsort(row[order], kind="stable")]
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (row[1:] != row[:-1]) | (g[1:] != g[:-1])
    g, row = g[new], row[new]
    return g, np.searchsorted(row, np.arange(len(count) + 1))


def _sum_rows(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def parity_bits(g: np.ndarray, first: np.ndarray) -> list[bytes]:
    """For each set, bits that tell whether an odd number of its n-grams falls on them; twice to four times as many bits as n-grams, a power of two.

    Two sets differ in at least as many n-grams as their bits differ in places, so bits bound the overlap from above.
    """
    where = C.mix(g + np.uint64(0x1234567))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        m = 1 << max(7, (b - a - 1).bit_length() + 1)
        odd = np.bincount((where[a:b] & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
        out.append(np.packbits(odd.astype(bool), bitorder="little").tobytes())
    return out


def survey(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """kind 0: doc_id, text_key, n, two sums (s1, s2) that name the set, and its parity bits; kind 1: parts of a task's n-gram counts (chunk in n, counters in counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_LOG2, np.int64)
        names = ["kind", "doc_id", "text_key", "n", "s1", "s2", "bits", "counts"]
        for batch in C.slices(batches, limit=SLICE):
            g, first = shingle_sets(*C.string_bytes(batch.column("text")), k)
            counts += np.bincount((g >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64), minlength=len(counts))
            n = len(first) - 1
            s1, s2 = _sum_rows(C.mix(g), first), _sum_rows(C.mix(g ^ np.uint64(0xA5A5A5A55A5A5A5A)), first)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(first)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(parity_bits(g, first), pa.binary()), pa.nulls(n, pa.binary())], names=names)
        for c in range(0, len(counts), SKETCH_CHUNK):
            part = counts[c : c + SKETCH_CHUNK]
            if part.any():
                row = [pa.array([1], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([c // SKETCH_CHUNK], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([part.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, names=names)

    return docs.mapInArrow(run, "kind int, doc_id long, text_key long, n long, s1 long, s2 long, bits binary, counts binary")


def sketch(surveyed: DataFrame) -> np.ndarray:
    """Counts by the top bits of the n-gram hash, of all documents: 2^SKETCH_LOG2 numbers whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, b in zip(batch.column("n").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[c] = total.get(c, 0) + np.frombuffer(b, np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["n", "counts"])

    out = np.zeros(1 << SKETCH_LOG2, np.int64)
    for c, b in surveyed.where("kind = 1").select("n", "counts").repartition("n").mapInArrow(run, "n long, counts binary").collect():
        out[c * SKETCH_CHUNK : (c + 1) * SKETCH_CHUNK] = np.frombuffer(bytes(b), np.int64)
    return out


def prefix_index(docs: DataFrame, counts: np.ndarray, percent: int, k: int, hot: int) -> DataFrame:
    """(gram, salt, node, n): the rarest n - ceil(t n) + 1 n-grams of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in C.slices(batches, limit=SLICE):
            g, first = shingle_sets(*C.string_bytes(batch.column("text")), k)
            n = np.diff(first)
            row = np.repeat(np.arange(len(n)), n)
            often = c[(g >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)].astype(np.int64)
            order = np.argsort(often, kind="stable")  # hashes are in order within a row already
            order = order[np.argsort(row[order], kind="stable")]
            place = np.arange(len(g)) - first[row]
            keep = place < (n - (percent * n + 99) // 100 + 1)[row]
            pick = order[keep]
            who = row[keep]
            node = batch.column("doc_id").to_numpy()[who]
            salt = np.where(often[pick] > hot, node % np.maximum(1, -(-often[pick] // hot)) + 1, 0)
            yield pa.RecordBatch.from_arrays([pa.array(g[pick].view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(node), pa.array(n[who].astype(np.int32))], names=["gram", "salt", "node", "n"])

    return docs.mapInArrow(run, "gram long, salt int, node long, n int")


def stars(index: DataFrame, percent: int) -> DataFrame:
    """Links between documents that share an n-gram of their prefixes and whose sizes allow the threshold: (u, v, gram, low, high).

    Sorted by size, documents of a gram fall into runs in which each next size allows the threshold; a run is a star around its smallest node. For
    salted grams a run also gives a row with gram, low and high sizes, so that runs of other salts can be joined.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        seen = np.zeros((0, 2), np.int64)

        def work(t: pa.Table) -> tuple[np.ndarray, pa.RecordBatch | None]:
            gram, salt, node, n = (t.column(c).to_numpy() for c in ("gram", "salt", "node", "n"))
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1]) | (n[:-1].astype(np.int64) * 100 < n[1:].astype(np.int64) * percent)
            head = np.flatnonzero(new)
            low = np.minimum.reduceat(node, head)
            center = np.repeat(low, np.diff(np.append(head, len(node))))
            pairs = np.stack([center, node], 1)[center != node]
            pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
            salted = np.flatnonzero(salt[head] > 0)
            tail = np.append(head[1:], len(node)) - 1
            extra = None
            if len(salted):
                extra = rows(low[salted], low[salted], gram[head[salted]], n[head[salted]], n[tail[salted]])
            return pairs, extra

        def rows(u, v, gram, lo, hi) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(gram, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["u", "v", "gram", "low", "high"])

        def plain(pairs: np.ndarray) -> pa.RecordBatch:
            m = len(pairs)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32())], names=["u", "v", "gram", "low", "high"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            gram = t.column("gram").to_numpy()
            end = int(np.searchsorted(gram, gram[-1])) if gram[0] <= gram[-1] else int(np.flatnonzero(gram != gram[-1])[-1]) + 1
            if end:
                pairs, extra = work(t.slice(0, end))
                seen = np.concatenate([seen, pairs])
                if extra is not None:
                    yield extra
                if len(seen) > 1 << 18:
                    seen = np.unique(seen, axis=0)
                    if len(seen) > 1 << 17:
                        yield plain(seen)
                        seen = seen[:0]
            rest = t.slice(end)
        if rest is not None and rest.num_rows:
            pairs, extra = work(rest)
            seen = np.concatenate([seen, pairs])
            if extra is not None:
                yield extra
        if len(seen):
            yield plain(np.unique(seen, axis=0))

    dealt = index.repartition("gram", "salt").sortWithinPartitions("gram", "salt", "n", "node")
    return dealt.mapInArrow(run, "u long, v long, gram long, low int, high int")


def join_salts(runs: DataFrame, percent: int) -> DataFrame:
    """(u, v) between runs of one gram whose sizes, from low to high, come near enough; runs are few: some for each salt."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, reach, center = None, 0, None
        for batch in batches:
            u, v = [], []
            for g, low, high, node in zip(*(batch.column(c).to_pylist() for c in ("gram", "low", "high", "u")), strict=True):
                if g == gram and reach * 100 >= low * percent:
                    u.append(center)
                    v.append(node)
                    reach = max(reach, high)
                else:
                    gram, reach, center = g, high, node
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return runs.repartition("gram").sortWithinPartitions("gram", "low", "high", "u").mapInArrow(run, "u long, v long")


def windows(members: DataFrame, most_documents: int, most_size: int, size: str, percent: int) -> DataFrame:
    """``members`` (component, node, n, ...) dealt to blocks (component, window) and their parts (part of parts).

    Sizes fall into classes whose bounds stand in the ratio of the threshold, so that two linked documents are in one class or in neighbouring ones; a window
    is two neighbouring classes, and a document is in two windows. A window over ``most_documents`` or ``most_size`` is cut into parts by a hash.
    """
    step = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    both = members.withColumn("window", F.explode(F.array(step, step - 1)))
    parts = F.greatest(F.ceil(F.count("*") / most_documents), F.ceil(F.sum(size) / most_size)).cast("int")
    count = both.groupBy("component", "window").agg(parts.alias("parts"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return both.join(count, ["component", "window"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def near_bits(members: DataFrame, percent: int) -> DataFrame:
    """(u, v): of the pairs in a block whose parity bits allow the threshold, links enough to connect what they connect.

    ``members``: (component, window, part, parts, node, n, bits).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, links = None, [], []
        for batch in batches:
            cols = ("component", "window", "a", "b", "part", "node", "n", "bits")
            for c, w, a, b, part, node, n, bits in zip(*(batch.column(x).to_pylist() for x in cols), strict=True):
                if (c, w, a, b) != key:
                    if key:
                        links += _near(held, key[2], key[3], percent)
                    key, held = (c, w, a, b), []
                held.append((part, node, n, bits))
            if len(links) > 100_000:
                yield edge_rows(links)
                links = []
        if key:
            links += _near(held, key[2], key[3], percent)
        yield edge_rows(links)

    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    sent = members.withColumn("other", other).select("component", "window", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "node", "n", "bits")
    dealt = sent.repartition("component", "window", "a", "b").sortWithinPartitions("component", "window", "a", "b")
    return dealt.mapInArrow(run, "u long, v long")


def _near(held: list[tuple], left: int, right: int, percent: int) -> list[tuple[int, int]]:
    if len(held) < 2:
        return []
    width = min(len(x[3]) for x in held)
    bits = np.empty((len(held), width), np.uint8)
    for i, x in enumerate(held):
        own = np.frombuffer(x[3], np.uint8)
        while len(own) > width:
            own = own[: len(own) // 2] ^ own[len(own) // 2 :]
        bits[i] = own
    wide, part, n, node = bits.view(np.uint64), np.array([x[0] for x in held]), np.array([x[2] for x in held]), np.array([x[1] for x in held])
    a, b = np.flatnonzero(part == left), np.flatnonzero(part == right)
    if not len(a) or not len(b):
        return []
    linked = np.zeros((len(a), len(b)), bool)
    for at in range(0, len(a), 64):
        rows = a[at : at + 64]
        apart = np.zeros((len(rows), len(b)), np.int64)
        for w in range(wide.shape[1]):
            apart += np.bitwise_count(wide[rows, w][:, None] ^ wide[b, w][None, :])
        total = n[rows][:, None] + n[b][None, :]
        linked[at : at + 64] = (apart * (100 + percent) <= (100 - percent) * total) & (np.minimum(n[rows][:, None], n[b][None, :]) * 100 >= percent * np.maximum(n[rows][:, None], n[b][None, :]))
    if left == right:
        np.fill_diagonal(linked, False)
    return _forest(linked, node[a].tolist(), node[b].tolist(), left == right)


def edge_rows(links: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*links, strict=True) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


@dataclass
class Member:
    node: int
    part: int
    grams: np.ndarray


def product(members: list[Member], left: int, right: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is linked between parts ``left`` and ``right`` (the same: within it)."""
    a = [m for m in members if m.part == left]
    b = a if left == right else [m for m in members if m.part == right]
    if not a or not b or (left == right and len(a) < 2):
        return []
    overlap = _overlaps(a, b)
    na, nb = np.array([len(m.grams) for m in a]), np.array([len(m.grams) for m in b])
    linked = 100 * overlap >= percent * (na[:, None] + nb[None, :] - overlap)
    linked &= overlap > 0
    if left == right:
        np.fill_diagonal(linked, False)
    return _forest(linked, [m.node for m in a], [m.node for m in b], left == right)


def _overlaps(a: list[Member], b: list[Member]) -> np.ndarray:
    """The product of two sparse incidence matrices: overlap counts of all rows. Columns of one side only are left out; columns with few entries are multiplied entry by entry,
    those with many, which a family shares, in dense strips."""
    ga, gb = np.concatenate([m.grams for m in a]), np.concatenate([m.grams for m in b])
    ra, rb = np.repeat(np.arange(len(a)), [len(m.grams) for m in a]), np.repeat(np.arange(len(b)), [len(m.grams) for m in b])
    kept = np.intersect1d(ga, gb)
    (ca, ra), (cb, rb) = _columns(ga, ra, kept), _columns(gb, rb, kept)
    na, nb = np.bincount(ca, minlength=len(kept)), np.bincount(cb, minlength=len(kept))
    light = na * nb * DENSE_RATIO < len(a) * len(b)
    out = _entries(ca[light[ca]], ra[light[ca]], cb[light[cb]], rb[light[cb]], (len(a), len(b)))
    heavy = np.flatnonzero(~light)
    at = np.cumsum(~light) - 1
    (ca, ra), (cb, rb) = ((at[c[~light[c]]], r[~light[c]]) for c, r in ((ca, ra), (cb, rb)))
    strip = max(256, (2 << 20) // (len(a) + len(b)))
    for c in range(0, len(heavy), strip):
        width = min(strip, len(heavy) - c)
        x, y = _dense(ca, ra, c, width, len(a)), _dense(cb, rb, c, width, len(b))
        out += np.rint(x @ y.T).astype(np.int64)
    return out


def _columns(grams: np.ndarray, row: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(column, row) of the entries whose n-gram is among ``kept``, by column."""
    if not len(kept):
        return np.zeros(0, np.int64), row[:0]
    at = np.minimum(np.searchsorted(kept, grams), len(kept) - 1)
    hit = kept[at] == grams
    order = np.argsort(at[hit], kind="stable")
    return at[hit][order], row[hit][order]


def _entries(ca: np.ndarray, ra: np.ndarray, cb: np.ndarray, rb: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """The product entry by entry: each pair of entries in one column adds one, a bounded number of pairs at a time."""
    out = np.zeros(shape[0] * shape[1], np.int64)
    low, high = np.searchsorted(cb, ca), np.searchsorted(cb, ca, "right")
    upto = np.concatenate([[0], np.cumsum(high - low)])
    at = 0
    while at < len(ca):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS_AT_ONCE, "right")) - 1)
        n = (high - low)[at:end]
        other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[at:end], n)
        out += np.bincount(np.repeat(ra[at:end], n) * shape[1] + rb[other], minlength=len(out))
        at = end
    return out.reshape(shape)


def _dense(column: np.ndarray, row: np.ndarray, start: int, width: int, rows: int) -> np.ndarray:
    p, q = np.searchsorted(column, (start, start + width))
    out = np.zeros((rows, width), np.float32)
    out[row[p:q], column[p:q] - start] = 1
    return out


def _forest(linked: np.ndarray, a: list[int], b: list[int], square: bool) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a (bipartite) link matrix."""
    out = []
    left_open, right_open = linked.any(1), linked.any(0)
    for i in range(len(a)):
        if not left_open[i]:
            continue
        left_open[i] = False
        if square:
            right_open[i] = False
        edge_l, edge_r = [i], []
        while edge_l or edge_r:
            if edge_l:
                x = edge_l.pop()
                new = np.flatnonzero(linked[x] & right_open)
                right_open[new] = False
                out += [(a[x], b[y]) for y in new]
                if square:
                    left_open[new] = False
                    edge_l += new.tolist()
                else:
                    edge_r += new.tolist()
            else:
                y = edge_r.pop()
                new = np.flatnonzero(linked[:, y] & left_open)
                left_open[new] = False
                out += [(a[x], b[y]) for x in new]
                edge_l += new.tolist()
    return out


def block_links(docs: DataFrame, blocks: DataFrame, percent: int, k: int) -> DataFrame:
    """(u, v) links. ``blocks``: (doc_id, places), places being structs (block, window, part, parts); each set goes to the pairs of parts that hold its part."""

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=SLICE):
            g, first = shingle_sets(*C.string_bytes(batch.column("text")), k)
            out: list[tuple] = []
            size = 0
            for r, (node, places) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("places").to_pylist(), strict=True)):
                own = g[first[r] : first[r + 1]].tobytes()
                for x in places:
                    for other in range(x["parts"]):
                        out.append((x["block"], x["window"], min(x["part"], other), max(x["part"], other), x["part"], node, own))
                        size += len(own)
                        if size > C.SLICE_BYTES:
                            yield pack(out)
                            out, size = [], 0
            if out:
                yield pack(out)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["block", "window", "a", "b", "part", "node", "grams"])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, links = None, [], []
        for batch in batches:
            for block, w, a, b, part, node, grams in zip(*(batch.column(c).to_pylist() for c in ("block", "window", "a", "b", "part", "node", "grams")), strict=True):
                if (block, w, a, b) != key:
                    if key:
                        links += product(members, key[2], key[3], percent)
                    key, members = (block, w, a, b), []
                if not members or members[-1].node != node:
                    members.append(Member(node, part, np.frombuffer(grams, np.uint64)))
            if len(links) > 100_000:
                yield edge_rows(links)
                links = []
        if key:
            links += product(members, key[2], key[3], percent)
        yield edge_rows(links)

    found = C.with_small(docs, blocks, "doc_id", BROADCAST_ROWS)
    shipped = found.mapInArrow(ship, "block long, window int, a int, b int, part int, node long, grams binary")
    dealt = shipped.repartition("block", "window", "a", "b").sortWithinPartitions("block", "window", "a", "b", "node")
    return dealt.mapInArrow(multiply, "u long, v long")


@dataclass
class Linked:
    """rows: a row for each document row (doc_id, text_key, n, s1, s2); classes: (s1, s2, n, class_id, component_id, first_key), where (component_id, first_key) is the row that stays."""

    rows: DataFrame
    classes: DataFrame


def linked(docs: DataFrame, percent: int, words: int, hot: int, block_documents: int, bits_documents: int) -> Linked:
    own = C.keyed_rows(docs).withColumn("text_key", F.xxhash64("text"))
    surveyed = C.materialize(survey(own, words))
    rows = surveyed.where("kind = 0").drop("kind", "counts")
    full = rows.where("n > 0 AND doc_id IS NOT NULL")
    named = full.groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("bits").alias("bits"))
    # A class has a number of its own, which its written table fixes.
    classes = C.materialize(named.select("s1", "s2", "n", "first.doc_id", "first.text_key", "bits", F.monotonically_increasing_id().alias("node")))
    numbered = C.materialize(own.join(classes.select("doc_id", "text_key", "node"), ["doc_id", "text_key"]).select(F.col("node").alias("doc_id"), "text"))
    starred = C.materialize(stars(prefix_index(numbered, sketch(surveyed), percent, words, hot), percent))
    near = C.materialize(starred.where("gram IS NULL").select("u", "v").unionByName(join_salts(starred.where("gram IS NOT NULL"), percent)).distinct())
    sizes = classes.select("node", "n", "bits")
    candidates = components(near).join(sizes, "node")
    dealt = windows(candidates.withColumn("size", F.octet_length("bits")), bits_documents, BITS_BYTES, "size", percent)
    nearer = C.materialize(near_bits(dealt, percent).distinct())
    blocks = windows(components(nearer).join(sizes.drop("bits"), "node"), block_documents, BLOCK_GRAMS, "n", percent)
    place = F.struct(F.col("component").alias("block"), "window", "part", "parts")
    blocks = C.materialize(blocks.groupBy(F.col("node").alias("doc_id")).agg(F.collect_set(place).alias("places")))
    links = C.materialize(block_links(numbered, blocks, percent, words))
    C.release(numbered, starred, near, nearer, blocks)
    groups = components(links)
    first = groups.join(classes, "node").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    found = C.materialize(groups.join(first, "component").select("node", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("first_key")))
    named = classes.join(found, "node", "left").select("s1", "s2", "n", F.col("doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("first_key", "text_key").alias("first_key"))
    return Linked(rows.drop("bits"), named)


def link(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, hot: int = HOT_GRAM, block_documents: int = BLOCK_DOCUMENTS, bits_documents: int = BITS_DOCUMENTS) -> DataFrame:
    """Per document row: doc_id, n_shingles, class_id (the smallest doc_id of an equal set) and component_id (the smallest doc_id reachable).

    Words are runs of bytes other than ASCII white space, A-Z lowered. A null or blank text has no n-grams, and is alone. Repeated rows each get their row. Rows link by
    their texts alone: rows that share a doc_id but not a text may be in different components. Rows without doc_id get their size and no component, and link nothing.
    """
    got = linked(docs, percent, words, hot, block_documents, bits_documents)
    out = got.rows.join(got.classes.drop("first_key"), ["s1", "s2", "n"], "left")
    named = lambda c: F.when(F.col("doc_id").isNotNull(), F.coalesce(c, "doc_id")).alias(c)
    return out.select("doc_id", F.col("n").alias("n_shingles"), named("class_id"), named("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, hot: int = HOT_GRAM, block_documents: int = BLOCK_DOCUMENTS, bits_documents: int = BITS_DOCUMENTS) -> DataFrame:
    """``docs`` with one document, that of the smallest doc_id, of each component; all columns stay.

    Rows without doc_id and rows without words stay. Rows that repeat both doc_id and text are one document, and stay or go together; of rows that share only the doc_id each
    is judged by its own text.
    """
    got = linked(docs, percent, words, hot, block_documents, bits_documents)
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("first_key"))
    leave = got.rows.where("doc_id IS NOT NULL").join(got.classes, ["s1", "s2", "n"]).where(~stays)
    own_id, own_key = C.fresh(docs, "__d", "__t")
    extra = C.materialize(leave.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct())
    same = (docs["doc_id"].cast("long") == F.col(own_id)) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == F.col(own_key))
    return docs.join(F.broadcast(extra) if C.is_small(extra, BROADCAST_ROWS) else extra, same, "left_anti")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(C.table(spark, sf_dir, "documents")).drop("class_id")


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(g) AS h, md5_number_lower(g) AS g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS g FROM t)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (h, g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edge AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e),
reach(u, v) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.u, edge.v FROM reach JOIN edge ON reach.v = edge.u),
c AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM documents LEFT JOIN n USING (doc_id) JOIN c ON c.u = documents.doc_id
"""
