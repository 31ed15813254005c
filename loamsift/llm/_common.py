"""What the training-data operators share: tables, scratch tables, and byte-level NumPy kernels.

The kernels work on the buffers of Arrow string columns, a few megabytes at a time, so memory is bounded by
``SLICE_BYTES`` (plus the longest single text) whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamsift.session import BATCH_BYTES, bound_batches, materialize, release, scratch_dir, spread  # noqa: F401  (used as C.materialize)

SLICE_BYTES = 2 << 20
PASS_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``; a small one is dealt to all cores (see session.spread)."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until they clash with no column of ``docs``, whatever its letters' case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def keyed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (key, text), null text as the empty string: other columns, whatever their names, take no part."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each has at most ``limit`` bytes in ``column``, or one row."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        _, offs = string_bytes(batch.column(column))
        at = 0
        while at < n:
            end = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
            end = min(max(end, at + 1), n)
            yield batch.slice(at, end - at)
            at = end


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without nulls, and row offsets into them (from 0)."""
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offs[0] : offs[-1]]
    return raw, offs - offs[0]


# ---- words and hashes -------------------------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_INK = np.ones(256, bool)  # not ASCII white space
_INK[[9, 10, 11, 12, 13, 32]] = False

_RANDOM = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE = _RANDOM.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0x9E3779B97F4A7C15 | 3, 0xC2B2AE3D27D4EB4F | 3)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """B^0..B^n and its inverse powers modulo 2^64."""
    if which not in _powers or len(_powers[which][0]) <= n:
        size, mod = max(n + 1, 1 << 16), 1 << 64
        out = []
        for b in (_BASE[which] % mod, pow(_BASE[which], -1, mod)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            out.append(p)
        _powers[which] = (out[0], out[1])
    return _powers[which]


def prefix_hash(raw: np.ndarray, which: int = 0) -> np.ndarray:
    """P with P[j] - P[i] = the sum of T[raw[t]] * B^t for i <= t < j, modulo 2^64."""
    up, _ = powers(len(raw) + 1, which)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[which][raw] * up[: len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of raw[start:end], equal for equal bytes wherever they stand."""
    _, down = powers(len(prefix), which)
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Words of a slice of texts: bytes start:end of ``low``, 64-bit ``hash``, first word of each row in ``first``."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, ink: bool = False):
        self.low = low = _LOWER[raw]
        n = len(low)
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        word = np.zeros(n + 2, bool)
        word[1:-1] = (_INK if ink else _WORD)[low]
        self.start = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
        self.end = np.flatnonzero(word[1:-1] & (~word[2:] | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offs)
        self.hash = span_hash(prefix_hash(low), self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def grams(symbol: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive symbols; the last k-1 places have none."""
    n = len(symbol) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + symbol[j : j + n]
    return mix(out)


def within(first: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which of the total-k+1 places start a k-gram that lies within one row."""
    n = max(total - k + 1, 0)
    ok = np.ones(n, bool)
    for j in range(1, k):
        at = first[1:-1] - j
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok


def int_lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A list column from flat values and the length of each row."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind or pa.int64()))


def rows_per_partition(df: DataFrame, per: int, most: int = 1 << 20) -> int:
    """How many partitions hold ``df`` with about ``per`` rows each; ``df`` should be a written table."""
    return max(1, min(most, -(-df.count() // per)))


#: Bytes in memory beyond which a table isn't broadcast, whatever its rows.
BROADCAST_BYTES = 32 << 20


def _width(kind: T.DataType, column: Column) -> Column:
    """Bytes of a value in Spark's row format, its length word included."""
    if isinstance(kind, T.ArrayType):
        each = kind.elementType
        if isinstance(each, T.ArrayType | T.StringType | T.BinaryType):
            inner = F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + 8 + _width(each, x))
        else:
            inner = F.size(column).cast("long") * (8 if not isinstance(each, T.StructType) else 16 + 8 * len(each.fields))
        return F.lit(24) + inner
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.lit(12) + F.octet_length(column).cast("long")
    return F.lit(8).cast("long")


def memory_bytes(found: DataFrame) -> tuple[int, int]:
    """(rows, bytes in memory) of a written table, counted and not taken from the size of its compressed files."""
    width = F.lit(16).cast("long")
    for f in found.schema.fields:
        width = width + F.coalesce(_width(f.dataType, F.col(f.name)), F.lit(8))
    rows, size = found.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return int(rows), int(size)


def is_small(found: DataFrame, most: int) -> bool:
    """Whether a written table is within BROADCAST_BYTES and ``most`` rows."""
    rows, size = memory_bytes(found)
    return rows <= most and size <= BROADCAST_BYTES


def with_small(rows: DataFrame, found: DataFrame, key: str, most: int) -> DataFrame:
    """Inner join on ``key`` to a written table: broadcast if it has at most ``most`` rows, else both sides are shuffled."""
    return rows.join(F.broadcast(found) if is_small(found, most) else found, key)


def passing(docs: DataFrame, text: str, change) -> DataFrame:
    """``docs`` through ``change(batch, raw, offs) -> batch``, all columns kept; raw and offs are the bytes of ``text``, null as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index(text)
            filled = batch.set_column(at, text, batch.column(at).fill_null(""))
            done = 0
            for part in slices(iter([filled]), text, PASS_BYTES):
                yield change(batch.slice(done, part.num_rows), *string_bytes(part.column(at)))
                done += part.num_rows

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
