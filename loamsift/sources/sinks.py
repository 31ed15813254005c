"""Sinks: Parquet, JSON lines, text, token files, metrics."""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.session import bound_batches, make_dir, materialize, qualified, without_shuffle_files

# Known input extensions, longest first.
EXTENSIONS = (".jsonl.zst", ".jsonl.gz", ".json.gz", ".jsonl", ".json", ".parquet", ".warc.wet.gz", ".warc.wet")


def output_name(path: str, kind: str = "parquet") -> str:
    """The base name with its extension replaced by that of ``kind`` (parquet or jsonl)."""
    base = os.path.basename(path)
    for e in EXTENSIONS:
        if base.endswith(e):
            base = base[: -len(e)]
            break
    return base + (".parquet" if kind == "parquet" else ".jsonl.zst")


def output_names(path: Column, kind: str = "parquet") -> Column:
    """output_name as a column."""
    known = "|".join(re.escape(e) for e in EXTENSIONS)
    return F.concat(F.regexp_replace(F.element_at(F.split(path, "/"), -1), f"({known})$", ""), F.lit(".parquet" if kind == "parquet" else ".jsonl.zst"))


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    """Zstandard Parquet, in a folder for each value of ``by``; an empty table leaves its schema."""
    w = df.write.option("compression", "zstd")
    (w.partitionBy(by) if by else w).parquet(path)


@contextmanager
def _whole_file(folder: str, name: str) -> Iterator[pafs.NativeFile]:
    """A file of a shared folder of any store: written under a name of this attempt, moved to its own when it is whole, so a repeated attempt leaves one whole file."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    part = f"{root}/.{name}.{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(part, compression=None) as f:
            yield f
    except BaseException:
        fs.delete_file(part)
        raise
    fs.move(part, f"{root}/{name}")


def write_json_lines(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """JSON lines with nulls written out. Spark has no Zstandard for text, so each task writes its own file into ``path``, a folder that all executors share."""
    if compression in ("none", "gzip"):
        df.write.option("ignoreNullFields", "false").option("compression", compression).json(path)
        return
    if compression != "zstd":
        raise ValueError("compression is zstd, gzip or none")
    line, folder = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), qualified(df.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        given = (f for f in frames if len(f))
        if (first := next(given, None)) is None:  # no rows, no file
            return
        n = 0
        with _whole_file(folder, f"part-{TaskContext.get().partitionId():05d}.jsonl.zst") as f, zstandard.ZstdCompressor(level=3).stream_writer(f, closefd=False) as z:
            for own in itertools.chain([first], given):
                for x in own["line"]:
                    z.write(x.encode() + b"\n")
                n += len(own)
        yield pd.DataFrame({"n": [n]})

    df.select(line.alias("line")).mapInPandas(run, "n long").agg(F.sum("n")).collect()


def write_files(files: DataFrame, path: str) -> int:
    """One file for each row (name, body as text or bytes) in ``path``, a folder that all executors share; the number of rows. Of rows with equal names one stays."""
    folder = qualified(files.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in frames:
            for name, body in zip(own["name"], own["body"], strict=True):
                with _whole_file(folder, name) as f:
                    f.write(bytes(body))
            yield pd.DataFrame({"n": [len(own)]})

    own = files.select("name", F.col("body").cast("binary").alias("body")).where("name IS NOT NULL AND body IS NOT NULL")
    return own.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_lines(docs: DataFrame, path: str) -> int:
    """One file for each document (name, text), a line break after its last line; a document without lines is an empty file."""
    return write_files(docs.select("name", F.when(F.col("text") == "", "").otherwise(F.concat("text", F.lit("\n"))).alias("body")), path)


def copy_survivors(files: DataFrame, kept: DataFrame, path: str) -> int:
    """Files (name, body) whose name is in ``kept``, byte for byte."""
    return write_files(files.join(kept.select("name").distinct(), "name", "left_semi"), path)


def rewrite_kept(rows: DataFrame, kept: DataFrame, key: str, file: str, path: str) -> DataFrame:
    """Rewrite files by a keep mask: of each ``file`` that loses rows, those whose ``key`` is in ``kept`` go to a folder of that file below ``path``; other files aren't touched.

    Returns (file, rows, kept, rewritten) for every file, as a written table; the input is never overwritten.
    """
    mask = rows.join(kept.select(key).distinct().withColumn("_kept", F.lit(1)), key, "left")
    counts = materialize(mask.groupBy(file).agg(F.count("*").alias("rows"), F.count("_kept").alias("kept")).withColumn("rewritten", F.col("kept") < F.col("rows")))
    changed = mask.where("_kept = 1").join(counts.where("rewritten").select(file), file, "left_semi").drop("_kept")
    write_parquet(changed, path, file)
    return counts


def training_lines(rows: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """(value): ``__label__<label> <text on one line>``."""
    from loamsift.functions.text import collapse

    return rows.select(F.concat(F.lit("__label__"), F.col(label), F.lit(" "), collapse(F.col(text))).alias("value"))


def token_bytes(tokens: DataFrame, ids: str = "ids", end: int | None = 50_256) -> DataFrame:
    """``tokens`` with ``bytes``: ids (and ``end``) as unsigned 16-bit numbers, little end first."""

    @F.pandas_udf("binary")
    def run(own: pd.Series) -> pd.Series:
        return own.map(one, na_action="ignore")

    def one(x: np.ndarray) -> bytes:
        own = np.concatenate([np.asarray(x, np.int64), tail])
        if len(own) and not 0 <= own.min() <= own.max() < 1 << 16:
            raise OverflowError("an id takes more than 16 bits")
        return own.astype("<u2").tobytes()

    tail = np.asarray([] if end is None else [end], np.int64)
    return tokens.withColumn("bytes", run(F.col(ids)))


def write_tokens(tokens: DataFrame, path: str, shard: str = "shard", order: str = "place") -> None:
    """One .bin file for each shard in ``path``, a shared folder: the ``bytes`` of its rows in order, streamed. Rows without bytes have no tokens; without rows the folder is empty."""
    spark, folder = tokens.sparkSession, qualified(tokens.sparkSession, path)
    bound_batches(spark)
    make_dir(spark, folder)

    @F.pandas_udf("binary")
    def packed(own: pd.Series) -> pd.Series:  # 16-bit ids shrink to a quarter or so, and a shard's rows are sorted together
        return own.map(zstandard.ZstdCompressor(level=1).compress)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpacked = zstandard.ZstdDecompressor().decompress
        rows = ((s, unpacked(b)) for own in frames for s, b in zip(own[shard], own["bytes"], strict=True))
        for name, own in itertools.groupby(rows, key=lambda x: x[0]):
            with _whole_file(folder, f"{name}.bin") as f:
                for _, b in own:
                    f.write(b)
        yield pd.DataFrame({"n": [0]})

    dealt = tokens.where("bytes IS NOT NULL").select(shard, order, packed("bytes").alias("bytes")).repartition(shard).sortWithinPartitions(shard, order)
    with without_shuffle_files(spark):
        dealt.mapInPandas(run, "n long").agg(F.sum("n")).collect()


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """One JSON object with sorted keys, in any store."""
    write_files(spark.createDataFrame([(os.path.basename(path), json.dumps(metrics, indent=2, sort_keys=True))], "name string, body string"), os.path.dirname(path))
