from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from loamsift.llm import packing as P

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def check(rows, got, length):
    exact = Tokenizer.from_file(PATHS[0])
    want = {}
    for doc, text in rows:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.setdefault(doc, []).append(ids)
    pieces, bins = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(want)
    for doc, own in pieces.items():
        n = len(want[doc])
        assert len({r.doc_tokens for r in own}) == 1 and sum(r.length for r in own) == n * own[0].doc_tokens
        for r in own:
            ids = want[doc][0]
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for spans in bins.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= length
    return len(bins)


def test_round_trip(docs_of):
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "word " * 9_000), (5, "é\n\n  x"), (6, "tie"), (7, "tie"), (8, "same"), (8, "same"), (None, "none")] + [(100 + i, "some words " * (i * 7 % 90)) for i in range(60)]
    check(rows, P.pack_documents(docs_of(rows, extra=True), *PATHS).collect(), 2048)


def test_whole_table(spark, sf, sf_tables):
    rows = [tuple(r) for r in sf_tables("documents").select("doc_id", "text").collect()]
    got = P.op8_packing(spark, sf).collect()
    bins = check(rows, got, 2048)
    assert bins * 2048 <= 1.03 * sum(r.length for r in got) + 2048


def test_groups_and_limits(docs_of):
    from loamsift.llm import _common as C

    rows = [(i, "w " * (i % 50)) for i in range(300)]
    pieces = C.materialize(P.tokenized_pieces(docs_of(rows), *PATHS, 128))
    got = P.pack(pieces, 128, segments=3, group=40).collect()
    check(rows, got, 128)
    sizes = {}
    for r in got:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + 1
    assert max(sizes.values()) <= 3


def test_conversations_under_all_three_limits(spark, sf):
    """Tokens, segments and loss-bearing tokens (those of the assistant's turns) of real conversations; each limit binds somewhere."""
    from pyspark.sql import functions as F

    from loamsift.llm import _common as C

    size = F.udf(lambda t: len(P._encoder(*PATHS)(t or "")), "long")
    turns = spark.read.parquet(f"{sf}/conversations.parquet").withColumn("n", size("text"))
    own = turns.groupBy("conv_id").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("role") == "assistant", F.col("n")).otherwise(0)).alias("loss_tokens"))
    own = own.select(F.col("conv_id").alias("doc_id"), F.lit(0).cast("long").alias("start"), (F.col("n") + 1).alias("length"), F.col("conv_id").alias("ids_crc32"), (F.col("n") + 1).alias("doc_tokens"), "loss_tokens")
    pieces = C.materialize(own)
    most = pieces.agg(F.max("length"), F.max("loss_tokens")).first()
    limits = (2 * most[0], 4, most[1] + 20)
    got = P.pack(pieces, limits[0], segments=limits[1], loss_tokens=limits[2], loss="loss_tokens", group=30)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in pieces.collect())
    used = got.groupBy("sequence_id").agg(F.sum("length").alias("t"), F.count("*").alias("s"), F.sum("loss_tokens").alias("l")).collect()
    assert all(r.t <= limits[0] and r.s <= limits[1] and r.l <= limits[2] for r in used)
    free = P.pack(pieces, limits[0], segments=limits[1], group=30).select("sequence_id").distinct().count()
    assert len(used) > free and any(r.s == limits[1] for r in used) and max(r.l for r in used) > limits[2] - 20


def test_dot_product_heuristic_respects_every_dimension():
    rng = np.random.default_rng(0)
    demand = np.stack([rng.integers(1, 100, 500), np.ones(500, int), rng.integers(0, 60, 500)], 1)
    capacity = np.array([200, 5, 90])
    bins, rank = P.dot_product_bins(demand, capacity)
    for b in range(bins.max() + 1):
        assert (demand[bins == b].sum(0) <= capacity).all() and sorted(rank[bins == b]) == list(range((bins == b).sum()))
    assert bins.max() + 1 <= 1.25 * max(np.ceil(demand.sum(0) / capacity))


def test_empty_table(docs_of):
    assert P.pack_documents(docs_of([]), *PATHS).count() == 0
