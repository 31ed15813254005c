"""Packing of tokenised documents by vector bin packing.

Each document is cut at multiples of the sequence length. Whole pieces of that length are sequences by themselves.
The remainders go, by a hash, to groups of bounded size, and in each group the dot-product heuristic fills one
sequence after another: of the pieces that still fit in every dimension (tokens, segments, loss-bearing tokens), it takes
that whose demand vector has the largest weighted dot product with the room left.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.llm import _common as C

SEQUENCE_TOKENS = 2048
MAX_SEGMENTS = 256
GROUP_PIECES = 16_384
END_OF_TEXT = 1
_SPECIAL = "<|endoftext|>"


@functools.cache
def _encoder(json_path: str, ranks_path: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @functools.cache
    def exact():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(json_path)

    def encode(text: str) -> list[int]:
        # Both files hold one vocabulary; only the JSON one knows the special string.
        if _SPECIAL in text:
            return exact().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def tokenized_pieces(docs: DataFrame, json_path: str, ranks_path: str, length: int = SEQUENCE_TOKENS, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if ``keep_ids``, the ids.

    A null text is empty; an empty text is the end token alone. Repeated rows are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(json_path, ranks_path)
        for batch in C.slices(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array(encode(text) + [END_OF_TEXT], "<u4")
                for at in range(0, len(ids), length):
                    piece = ids[at : at + length]
                    out.append((doc, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), *([piece.astype(np.int64)] * keep_ids)))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64()) if i == 5 else pa.int64()) for i, c in enumerate(cols)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] * keep_ids)]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * keep_ids
    return C.keyed_rows(docs).mapInArrow(run, schema)


def dot_product_bins(demand: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and its rank there, by the dot-product heuristic.

    Items of equal demand are one type, so a step costs as much as there are types. Weights are the total demand
    in a dimension over its capacity. Ties go to the type with most tokens (the first dimension).
    """
    n = len(demand)
    types, inverse = np.unique(-demand, axis=0, return_inverse=True)
    types, inverse = -types, inverse.ravel()
    left = np.bincount(inverse, minlength=len(types))
    order = np.argsort(inverse, kind="stable")
    taken = np.concatenate([[0], np.cumsum(left)[:-1]])
    weight = demand.sum(0) / np.maximum(capacity, 1) / max(n, 1)
    scaled = types * weight / np.maximum(capacity, 1)
    bins, rank = np.zeros(n, np.int64), np.zeros(n, np.int64)
    bin_no, room, filled, done = 0, capacity.astype(np.int64).copy(), 0, 0
    while done < n:
        fits = (left > 0) & (types <= room).all(1)
        if not fits.any():
            if not filled:
                raise ValueError("an item exceeds the capacity")
            bin_no, room, filled = bin_no + 1, capacity.astype(np.int64).copy(), 0
            continue
        score = np.where(fits, scaled @ (room / np.maximum(capacity, 1)), -1.0)
        t = int(np.argmax(score))
        item = order[taken[t]]
        taken[t] += 1
        left[t] -= 1
        room -= types[t]
        bins[item], rank[item] = bin_no, filled
        filled += 1
        done += 1
    return bins, rank


def pack(pieces: DataFrame, length: int = SEQUENCE_TOKENS, segments: int = MAX_SEGMENTS, loss_tokens: int | None = None, loss: str = "length", group: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (a written table) with sequence_id and offset.

    ``loss`` names the column of loss-bearing tokens. Sequence ids are unique, not dense. A group has about ``group``
    pieces, dealt by a hash of the piece, so neither a hot source nor a long document makes a group larger.
    """
    capacity = np.array([length, segments, loss_tokens or length], np.int64)
    groups = C.rows_per_partition(pieces, group)

    def place(g: int, df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["doc_id", "start", "ids_crc32", "length"], na_position="first").reset_index(drop=True)
        demand = np.stack([df["length"], np.ones(len(df), np.int64), df["_loss"]], 1).astype(np.int64)
        bins, rank = dot_product_bins(demand, capacity)
        placed = np.lexsort((rank, bins))
        lengths = df["length"].to_numpy()[placed]
        run_total = np.cumsum(lengths) - lengths
        first = np.searchsorted(bins[placed], np.arange(bins.max() + 1))
        offset = np.empty(len(df), np.int64)
        offset[placed] = run_total - run_total[first][bins[placed]]
        df["sequence_id"], df["offset"] = bins * groups + g, offset
        return df.drop(columns=["_group", "_loss"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come group by group; one group is held at a time."""
        now, held = None, []
        for frame in frames:
            for g, df in frame.groupby("_group"):
                if g != now and held:
                    yield place(now, pd.concat(held))
                    held = []
                now = g
                held.append(df)
        if held:
            yield place(now, pd.concat(held))

    schema = pieces.select("*").schema.add("sequence_id", "long").add("offset", "long")
    dealt = pieces.select("*", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).alias("_group"), F.coalesce(F.col(loss), F.lit(0)).cast("long").alias("_loss"))
    return dealt.repartition(groups, "_group").sortWithinPartitions("_group").mapInPandas(run, schema)


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, length: int = SEQUENCE_TOKENS) -> DataFrame:
    """Tokenise, cut and pack ``docs``; see tokenized_pieces and pack."""
    return pack(C.materialize(tokenized_pieces(docs, json_path, ranks_path, length)), length)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
