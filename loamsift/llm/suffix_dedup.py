"""Removal of byte strings that stand more than once, by merging shards' sparse suffix orders.

A shard is a few megabytes of documents. Of its suffixes it keeps those at anchors: the minimizer of each window of ``SPAN`` k-grams, so that every
string of ``length`` bytes has an anchor that depends on that string alone, and equal strings have theirs at the same place. Shards are merged by refining
an interleave: suffixes of all shards start in one block for each common prefix of an anchor (its core); blocks that hold one suffix are done and leave; an
anchor whose whole neighbourhood (all strings it answers for, with what precedes and follows) recurs is an inner place of a repeated interval and leaves with all its strings; what is
left are the ends of intervals, whose strings are refined block by block, symbol after symbol of growing width, until a block has one string
(its common prefix with any other is shorter than ``length``) or the common prefix reaches ``length``. Nothing is sorted
anew as a whole, and unique text leaves in the first round.

Two lengths come from one pass over the corpus: a string of ``length`` bytes that recurs lies within a run of recurring strings of fewer bytes, so the longer ones are
searched in those runs only. The shorter length is for passages: over 50 words may take fewer than 400 bytes.

``merge_transforms`` is the byte-wise form on whole Burrows-Wheeler transforms, for small collections and as the reference in tests: it needs a
pass over all bytes for each byte of the longest common prefix up to ``length``, which the README's figures show to be too slow for whole corpora.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.llm import _common as C

LENGTH = 400
#: Passages are runs of at least so many words, covered by strings of so many bytes that also start elsewhere: 51 words of five bytes, less those that differ at an edge.
PASSAGE_WORDS = 51
PASSAGE_BYTES = 240
GRAM = 8
#: Members of a core beyond which it is dealt out by a salt and merged in two rounds.
HOT = 20_000
SHARD_BYTES = 1 << 20


def span_of(length: int) -> int:
    """Window of k-gram places: large for few anchors, small for a selective core; its last k-gram must end within the string."""
    if length < GRAM:
        raise ValueError(f"strings have at least {GRAM} bytes")
    return min(length * 2 // 3, length - GRAM + 1)


# ---- byte-wise merge -------------------------------------------------------------------------------------------


def transform(texts: list[bytes]) -> np.ndarray:
    """The Burrows-Wheeler transform of a small shard: symbols 1..256 are bytes, 0 closes each text; closers sort by their order."""
    s = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.int64) + 1, 0) for t in texts])
    n = len(s)
    start = np.concatenate([[0], np.flatnonzero(s == 0)[:-1] + 1])
    rank = np.where(s == 0, np.cumsum(s == 0), s + len(texts))
    k = 1
    while k < n:
        nxt = np.zeros(n, np.int64)
        nxt[:-k] = rank[k:] + 1
        _, fresh = np.unique(rank * (n + len(texts) + 300) + nxt, return_inverse=True)
        done = fresh.max() == n - 1
        rank, k = fresh, k * 2
        if done:
            break
    order = np.argsort(rank)
    before = order - 1
    own_end = np.zeros(n, np.int64)
    own_end[start] = np.flatnonzero(s == 0)
    before = np.where(np.isin(order, start), own_end[order], before)
    return s[before]


def merge_transforms(bwts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge by refining the interleave: (source of each merged suffix, its rank there, common prefix with the one before, up to ``length``).

    After h rounds the interleave is right for prefixes of h symbols. A block boundary that appears in round h has a common prefix of h - 1. Closers differ from each other.
    """
    n = sum(map(len, bwts))
    source = np.repeat(np.arange(len(bwts)), [len(b) for b in bwts])
    lcp = np.full(n, -1)
    lcp[0] = 0
    begin = np.concatenate([[0], np.cumsum([len(b) for b in bwts])])
    flat = np.concatenate(bwts)
    inner = np.empty(n, np.int64)
    block = np.zeros(n, np.int64)
    for h in range(1, length + 1):
        for s in range(len(bwts)):
            at = np.flatnonzero(source == s)
            inner[at] = np.arange(len(at))
        symbol = flat[begin[source] + inner]
        order = np.argsort(symbol, kind="stable")
        symbol, moved = symbol[order], block[order]
        cut = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (moved[1:] != moved[:-1]) | (symbol[1:] == 0)])
        source = source[order]
        fresh = cut & (lcp < 0)
        lcp[fresh] = h - 1
        block = np.cumsum(cut) - 1
        if (lcp >= 0).all():
            break
    lcp[lcp < 0] = length
    for s in range(len(bwts)):
        at = np.flatnonzero(source == s)
        inner[at] = np.arange(len(at))
    return source, inner, lcp


# ---- anchors ---------------------------------------------------------------------------------------------------


def gram_values(raw: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the GRAM bytes from each place on; near the end, of those there are."""
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(GRAM, np.uint8)])
    out = np.empty(n, np.uint64)
    for j in range(GRAM):
        part = padded[j : j + (n - j + GRAM - 1) // GRAM * GRAM]
        part = part[: len(part) // GRAM * GRAM].view("<u8")
        out[j::GRAM] = part[: len(out[j::GRAM])]
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out >> np.uint64(32)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[p : p + width]) for each p that has so many, by minima from block ends both ways."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = max(n - width + 1, 0)
    return np.minimum(back[:m], ahead[width - 1 : width - 1 + m])


def anchors(raw: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first and last start it answers for, row): places are bytes of ``raw``. A string that starts at p has its anchor in [p, p + span)."""
    none = np.zeros(0, np.int64)
    span = span_of(length)
    size = np.diff(offs)
    if not (size >= length).any():
        return none, none, none, none
    key = gram_values(raw) << np.uint64(32) | np.arange(len(raw), dtype=np.uint64)
    low = (sliding_minimum(key, span) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    step = np.zeros(len(raw) + 1, np.int64)
    rows = np.flatnonzero(size >= length)
    np.add.at(step, offs[rows], 1)
    np.add.at(step, offs[rows] + size[rows] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(step[:-1])[: len(low)] > 0)
    a = low[start]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)])
    begin = np.flatnonzero(new)
    lo, hi = start[begin], start[np.concatenate([begin[1:], [len(start)]]) - 1]
    return a[begin], lo, hi, np.searchsorted(offs, lo, "right") - 1


ANCHOR = "kind int, core long, full long, n long, doc_id long, text_key long, at int, lo int, hi int"
ANCHOR_NAMES = ["kind", "core", "full", "n", "doc_id", "text_key", "at", "lo", "hi"]


def shard_anchors(docs: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """For each shard, one row (kind 0) for each distinct neighbourhood of an anchor, with how often it occurs there, and rows (kind 1) lo..hi of starts
    whose strings recur within the shard."""
    span = span_of(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=shard_bytes):
            raw, offs = C.string_bytes(batch.column("text"))
            a, lo, hi, row = anchors(raw, offs, length)
            if not len(a):
                continue
            p0, p1 = C.prefix_hash(raw, 0), C.prefix_hash(raw, 1)
            core = C.span_hash(p0, a, a + length - span + 1)
            full = C.mix(C.span_hash(p1, lo, hi + length, 1) + (a - lo).astype(np.uint64))
            order = np.lexsort((full, core))
            same = (core[order][1:] == core[order][:-1]) & (full[order][1:] == full[order][:-1])
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            count = np.diff(np.concatenate([first, [len(a)]]))
            keep = order[first]
            doc, key = batch.column("doc_id"), batch.column("text_key")
            again = np.sort(order[np.repeat(count > 1, count)])
            # Neighbouring ranges of starts are joined, so a run that repeats itself is one row.
            cut = np.concatenate([[True], (lo[again][1:] > hi[again][:-1] + length) | (row[again][1:] != row[again][:-1])]) if len(again) else np.zeros(0, bool)
            heads = np.flatnonzero(cut)
            k1 = again[heads]
            end = np.maximum.reduceat(hi[again], heads) if len(heads) else hi[:0]
            base = offs[row]
            which = np.concatenate([keep, k1])
            rows = pa.array(row[which])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([0, 1], [len(keep), len(k1)]), pa.int32()),
                    pa.array(core[which].view(np.int64)),
                    pa.array(full[which].view(np.int64)),
                    pa.array(np.concatenate([count, np.zeros(len(k1), np.int64)])),
                    doc.take(rows),
                    key.take(rows),
                    pa.array((a - base)[which], pa.int32()),
                    pa.array((lo - base)[which], pa.int32()),
                    pa.array(np.concatenate([hi[keep], end]) - base[which], pa.int32()),
                ],
                names=ANCHOR_NAMES,
            )

    return docs.mapInArrow(run, ANCHOR)


# ---- refinement of interval ends -------------------------------------------------------------------------------


def refine(raw: np.ndarray, place: np.ndarray, block: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(which strings recur in their block, a hash of each string). Strings start at ``place`` in ``raw``.

    In each round the blocks are split by the next symbol, wider than the one before, and blocks of one string leave.
    """
    p = C.prefix_hash(raw, 1)
    live, done = np.arange(len(place)), np.zeros(len(place), bool)
    name, at, width = C.mix(block), 0, 16
    while at < length and len(live):
        to = min(length, at + width)
        nxt = C.mix(name * np.uint64(0x9E3779B97F4A7C15) + C.span_hash(p, place[live] + at, place[live] + to, 1))
        order = np.argsort(nxt)
        s = nxt[order]
        same = s[1:] == s[:-1]
        multi = np.zeros(len(s), bool)
        multi[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        live, name = live[multi], nxt[multi]
        at, width = to, width * 2
    done[live] = True
    return done, C.mix(block * np.uint64(0xA24BAED4963EE407) + C.span_hash(p, place, place + length, 1))


def resolve_ends(contexts: DataFrame, length: int) -> DataFrame:
    """``contexts`` (core, salts, salt, doc_id, text_key, at, lo, hi, n, bytes) to rows (doc_id, text_key, lo, hi, string): starts whose strings recur
    (string null), and for salted cores one row for each distinct string (its hash; lo null if it is known to recur)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(tables: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            t = pa.Table.from_batches(tables).combine_chunks()
            col = {c: t.column(c).to_numpy() for c in ("core", "salts", "salt", "at", "lo", "hi", "n")}
            chunk = t.column("bytes").combine_chunks()
            raw, offs = C.string_bytes(chunk.chunk(0) if isinstance(chunk, pa.ChunkedArray) else chunk)
            n = col["hi"] - col["lo"] + 1
            member = np.repeat(np.arange(len(n)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            name = C.mix(col["core"].view(np.uint64) + C.mix(col["salt"].astype(np.uint64) + np.uint64(77)))
            block = C.mix(name[member] + ((col["at"] - col["lo"])[member] - k).astype(np.uint64))  # a core, and how far before its anchor a string starts
            again, string = refine(raw, offs[:-1][member] + k, block, length)
            plain = np.flatnonzero(again & (col["n"] == 1)[member])
            start = col["lo"][member] + k
            if len(plain):  # neighbouring starts of a member are one range
                cut = np.concatenate([[True], (member[plain][1:] != member[plain][:-1]) | (k[plain][1:] != k[plain][:-1] + 1)])
                heads = np.flatnonzero(cut)
                tails = np.concatenate([heads[1:], [len(plain)]]) - 1
            else:
                heads = tails = np.zeros(0, np.int64)
            who = member[plain[heads]] if len(plain) else heads
            lo, hi = (start[plain[heads]], start[plain[tails]]) if len(plain) else (heads, heads)
            cols = [t.column("doc_id").take(pa.array(who)), t.column("text_key").take(pa.array(who)), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.nulls(len(who), pa.int64())]
            parts = [pa.Table.from_arrays(cols, names=names)]
            salted = np.flatnonzero((col["salts"] > 1)[member])
            if len(salted):
                # across salts a string is named without its salt
                whole = C.mix(C.mix(col["core"].view(np.uint64)[member[salted]]) + C.span_hash(C.prefix_hash(raw, 1), offs[:-1][member[salted]] + k[salted], offs[:-1][member[salted]] + k[salted] + length, 1))
                _, first = np.unique(whole + C.mix(col["salt"].astype(np.uint64))[member[salted]], return_index=True)  # one for each salt
                one = salted[first]
                known = again[one] | (col["n"] > 1)[member[one]]
                at = pa.array(start[one], pa.int32(), mask=known)
                cols = [t.column("doc_id").take(pa.array(member[one])), t.column("text_key").take(pa.array(member[one])), at, at, pa.array(whole[first].view(np.int64))]
                parts.append(pa.Table.from_arrays(cols, names=names))
            return pa.concat_tables(parts)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column("core").to_numpy(), batch.column("salt").to_numpy()], 1)
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            if held:
                last = (held[-1].column("core")[-1].as_py(), held[-1].column("salt")[-1].as_py())
                if last != tuple(keys[0]):
                    ends = np.concatenate([[0], ends])
            # Cut only where a core ends, once enough is held.
            at = 0
            for e in ends:
                if size + batch.column("bytes").nbytes * (e - at) // batch.num_rows > SHARD_BYTES:
                    if e > at:
                        held.append(batch.slice(at, e - at))
                    if held:
                        yield from flush(held).to_batches()
                    held, size, at = [], 0, int(e)
            if at < batch.num_rows:
                held.append(batch.slice(at))
                size += batch.column("bytes").nbytes * (batch.num_rows - at) // batch.num_rows
        if held:
            yield from flush(held).to_batches()

    names = ["doc_id", "text_key", "lo", "hi", "string"]
    dealt = contexts.repartition("core", "salt").sortWithinPartitions("core", "salt")
    return dealt.mapInArrow(run, "doc_id long, text_key long, lo int, hi int, string long")


def with_texts(docs: DataFrame, found: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Join (doc_id, text_key, *columns), a row for each key, to the documents. Both sides are shuffled: ``found`` grows with the documents."""
    keyed = found.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), *columns)
    return docs.join(keyed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), how).drop("_d", "_t")


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, text_key, spans): maximal runs (start, stop) of bytes covered by a string of ``length`` bytes that also starts elsewhere.

    ``docs`` has doc_id, text and text_key. Only documents with such a run have a row. The result is a written table.
    """
    found = C.materialize(shard_anchors(docs, length, shard_bytes))
    own = found.where("kind = 0")
    place = F.struct("doc_id", "text_key", "at", "lo", "hi")
    # Unique text leaves here: of most cores there is one suffix. several: more than one neighbourhood.
    cores = own.groupBy("core").agg(F.sum("n").alias("_n"), (F.min("full") != F.max("full")).alias("several")).where("_n > 1").drop("_n")
    shared = C.materialize(own.join(cores, "core").unionByName(found.where("kind = 1").withColumn("several", F.lit(False))))
    C.release(found)
    own = shared.where("kind = 0")
    blocks = C.materialize(own.groupBy("core", "full").agg(F.sum("n").alias("n"), F.count("*").alias("shards"), F.min(place).alias("one"), F.bool_or("several").alias("several")))
    cores = blocks.where("several").groupBy("core").agg(F.count("*").alias("fulls"))
    # Inner places: a neighbourhood that two shards share; those that one shard repeats were given by the shard itself.
    inner = own.join(blocks.where("shards > 1").select("core", "full"), ["core", "full"], "left_semi").select("doc_id", "text_key", "lo", "hi")
    ends = blocks.where("several").join(cores, "core").select("core", F.least("n", F.lit(2)).alias("n"), "one.*", F.ceil(F.col("fulls") / hot).cast("long").alias("salts"))
    wanted = F.collect_list(F.struct("core", "salts", "n", "at", "lo", "hi")).alias("wanted")
    by_doc = C.materialize(ends.groupBy("doc_id", "text_key").agg(wanted))
    contexts = with_texts(docs.where(F.octet_length("text") >= length), by_doc, ["wanted"], "inner").mapInArrow(_cut(length), CONTEXT)
    salted = contexts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_key", "at"), F.col("salts")))
    resolved = C.materialize(resolve_ends(salted, length))
    again = resolved.where("string IS NOT NULL").groupBy("string").agg(F.count("*").alias("k"), F.collect_list(F.when(F.col("lo").isNotNull(), F.struct("doc_id", "text_key", "lo", "hi"))).alias("open")).where("k > 1")
    across = again.select(F.explode("open").alias("x")).select("x.*")
    starts = inner.unionByName(resolved.where("string IS NULL").drop("string")).unionByName(across).unionByName(shared.where("kind = 1").select("doc_id", "text_key", "lo", "hi"))
    runs = starts.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("starts"))
    out = C.materialize(runs.mapInArrow(_merge_runs(length), "doc_id long, text_key long, spans array<array<int>>"))
    C.release(shared, blocks, by_doc, resolved)
    return out


def spans_within(docs: DataFrame, near: DataFrame, length: int, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """repeated_spans of ``docs`` for ``length``, from ``near``, those of a shorter length: each of its runs that is long enough is searched as a text of its own."""
    long_ = near.select("doc_id", "text_key", F.filter("spans", lambda x: x[1] - x[0] >= length).alias("runs")).where(F.size("runs") > 0)
    runs = C.materialize(long_)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=SHARD_BYTES):
            raw, offs = C.string_bytes(batch.column("text"))
            data, own = raw.tobytes(), batch.column("runs").to_pylist()
            row = np.repeat(np.arange(len(own)), [len(x) for x in own])
            start = [a for x in own for a, _ in x]
            part = [data[offs[r] + a : offs[r] + z] for r, x in enumerate(own) for a, z in x]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(start, pa.int32()), pa.array(part, pa.binary())], names=["doc_id", "base", "start", "text"])

    parts = with_texts(docs, runs, ["runs"], "inner").select("doc_id", "text_key", "text", "runs").mapInArrow(cut, "doc_id long, base long, start int, text binary")
    parts = C.materialize(parts.withColumn("text_key", F.xxhash64("base", "start")))
    found = repeated_spans(parts.select("doc_id", "text_key", "text"), length, hot, shard_bytes)
    place = parts.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "base", "start").distinct()
    back = found.join(place, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")))
    moved = F.transform("spans", lambda x: F.array(x[0] + F.col("start"), x[1] + F.col("start")))
    whole = back.select("doc_id", F.col("base").alias("text_key"), moved.alias("spans")).groupBy("doc_id", "text_key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    out = C.materialize(whole)
    C.release(runs, parts, found)
    return out


CONTEXT = "core long, salts long, n long, doc_id long, text_key long, at int, lo int, hi int, bytes binary"


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=SHARD_BYTES):
            raw, offs = C.string_bytes(batch.column("text"))
            data = raw.tobytes()
            out: list[tuple] = []
            size = 0
            seen = set()
            for r, (doc, key, wanted) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("wanted").to_pylist(), strict=True)):
                if (doc, key) in seen:
                    continue
                seen.add((doc, key))
                for w in wanted:
                    part = data[offs[r] + w["lo"] : offs[r] + w["hi"] + length]
                    out.append((w["core"], w["salts"], w["n"], doc, key, w["at"], w["lo"], w["hi"], part))
                    size += len(part)
                    if size > SHARD_BYTES:
                        yield pack(out)
                        out, size = [], 0
            if out:
                yield pack(out)

    kinds = [pa.int64()] * 5 + [pa.int32()] * 3 + [pa.binary()]
    names = ["core", "salts", "n", "doc_id", "text_key", "at", "lo", "hi", "bytes"]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    return run


def _merge_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for starts in batch.column("starts").to_pylist():
                runs: list[list[int]] = []
                for s in starts:
                    if runs and s["lo"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["hi"] + length)
                    else:
                        runs.append([s["lo"], s["hi"] + length])
                out.append(runs)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(out, pa.list_(pa.list_(pa.int32())))], names=["doc_id", "text_key", "spans"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, shard_bytes: int = SHARD_BYTES, passage: int = PASSAGE_BYTES, words: int = PASSAGE_WORDS) -> DataFrame:
    """Per document row: doc_id, kept (binary), n_bytes, spans (removed runs, in bytes of the input) and passages.

    Texts are UTF-8 bytes, a null text is empty; matches don't cross documents. All strings are judged on the input. A repeated row is another document, so all its
    strings of ``length`` bytes recur; so are rows with a null doc_id. Texts under ``length`` bytes are kept whole. passages are the maximal runs covered by strings of
    ``passage`` bytes (fewer than ``length``) that also start elsewhere, of at least ``words`` pieces between ASCII white space; they are reported, and removed only where spans say so.
    """
    if not 0 < passage < length:
        raise ValueError("passage must be shorter than length")
    own = C.keyed_rows(docs).withColumn("text_key", F.xxhash64("text"))
    near = repeated_spans(own, passage, hot, shard_bytes)
    spans = spans_within(own, near, length, hot, shard_bytes)
    either = spans.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "spans")
    both = C.materialize(near.withColumnRenamed("spans", "passages").join(either, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left").drop("_d", "_t"))
    C.release(near, spans)
    joined = with_texts(own, both, ["spans", "passages"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = pa.list_(pa.list_(pa.int32()))
        for batch in C.slices(batches):
            raw, offs = C.string_bytes(batch.column("text"))
            data = raw.tobytes()
            spans, near = ([x or [] for x in batch.column(c).to_pylist()] for c in ("spans", "passages"))
            kept = [_without(data[offs[r] : offs[r + 1]], x) for r, x in enumerate(spans)]
            near = [[[a, z] for a, z in x if len(data[offs[r] + a : offs[r] + z].split()) >= words] for r, x in enumerate(near)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(np.diff(offs)), pa.array(spans, runs), pa.array(near, runs)], names=["doc_id", "kept", "n_bytes", "spans", "passages"])

    return joined.select("doc_id", "text", "spans", "passages").mapInArrow(run, "doc_id long, kept binary, n_bytes long, spans array<array<int>>, passages array<array<int>>")


def deduplicate(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE_BYTES, words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, n_chars following it; all columns stay.

    A passage is a maximal run of bytes covered by strings of ``passage`` bytes that also start elsewhere; it goes if it has ``length`` bytes or ``words`` pieces between
    ASCII white space. So every string of ``length`` bytes that recurs goes, and every passage of over 50 words that recurs and has ``passage`` bytes.
    Bytes of a character that is cut in two are left out. A null text stays null; a text that is removed as a whole is empty. Repeated rows lose all that is long enough.
    """
    own = C.keyed_rows(docs).withColumn("text_key", F.xxhash64("text"))
    spans = repeated_spans(own, passage)
    own_id, own_key, own_spans = C.fresh(docs, "__d", "__t", "__spans")
    keyed = spans.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), F.col("spans").alias(own_spans))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(own_key))
    joined = docs.join(keyed, same, "left").drop(own_id, own_key)
    names = docs.columns

    def change(batch: pa.RecordBatch, raw: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
        data, texts = raw.tobytes(), batch.column("text").to_pylist()
        for r, found in enumerate(batch.column(own_spans).to_pylist()):
            if found:
                own = data[offs[r] : offs[r + 1]]
                gone = [(a, z) for a, z in found if z - a >= length or len(own[a:z].split()) >= words]
                texts[r] = _without(own, gone).decode("utf-8", "ignore") if gone else texts[r]
        cols = {c: batch.column(c) for c in [*names, own_spans]}
        cols["text"] = pa.array(texts, batch.schema.field("text").type)
        if "n_chars" in cols:
            cols["n_chars"] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field("n_chars").type)
        return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return C.passing(joined, "text", change).select(*names)


def _without(text: bytes, spans: list) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def _total(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x[1] - x[0])


def digest(done: DataFrame) -> DataFrame:
    """The contract's columns; then how many passages of over 50 words recur (n_passages), and their bytes."""
    passages = (F.size("passages").cast("long").alias("n_passages"), _total("passages").alias("passage_bytes"))
    return done.select("doc_id", "n_bytes", _total("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), *passages)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(remove_repeats(C.table(spark, sf_dir, "documents")))


def _runs_sql(name: str, length: int) -> str:
    """Common table expressions: ``name`` has doc_id and, in order, the starts (a) and ends (z) of the runs, from 1 and past the last byte."""
    return f"""w{name} AS (SELECT doc_id, p, md5(b[p : p + {length - 1}]) AS h FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - {length - 2})) AS p FROM d WHERE octet_length(b) >= {length})),
r{name} AS (SELECT doc_id, p FROM w{name} WHERE h IN (SELECT h FROM w{name} GROUP BY h HAVING count(*) > 1)),
g{name} AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= {length} THEN 0 ELSE 1 END AS new FROM r{name})),
{name} AS (SELECT doc_id, min(p) AS a, max(p) + {length} AS z FROM g{name} GROUP BY doc_id, run)"""


ORACLE = rf"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x FROM documents),
{_runs_sql("s", LENGTH)},
{_runs_sql("q", PASSAGE_BYTES)},
l AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z, sum(z - a) AS n_removed, count(*) AS n_spans FROM s GROUP BY doc_id),
k AS (SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  CASE WHEN l.a IS NULL THEN b ELSE list_reduce(list_prepend(b[1 : l.a[1] - 1], list_transform(range(1, len(l.a) + 1), lambda i: b[l.z[i] : coalesce(l.a[i + 1], octet_length(b) + 1) - 1])), lambda x, y: x || y) END AS kept FROM d LEFT JOIN l USING (doc_id)),
p AS (SELECT doc_id, count(*) AS n_passages, sum(z - a) AS passage_bytes FROM q JOIN d USING (doc_id)
  WHERE len(list_filter(regexp_split_to_array(regexp_replace(substring(x, (2 * a - 1)::BIGINT, (2 * (z - a))::BIGINT), '(..)', '\1 ', 'g'), '(09|0A|0B|0C|0D|20) '), lambda y: y <> '')) >= {PASSAGE_WORDS} GROUP BY doc_id)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(kept) AS kept_sha256, coalesce(n_passages, 0)::BIGINT AS n_passages, coalesce(passage_bytes, 0)::BIGINT AS passage_bytes
FROM k LEFT JOIN p USING (doc_id)
"""
