"""Sources: Parquet, JSON lines, text files, CDX, token files."""

from __future__ import annotations

import glob
import hashlib
import itertools
import os
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamsift.operators.sampling import first_rows
from loamsift.session import bound_batches

#: What Spark's text readers would take as plain text, without an error.
UNREADABLE = (".xz", ".lzma", ".7z", ".zip")


def sorted_slice(paths: list[str], start: int = 0, most: int | None = None) -> list[str]:
    """paths in order, [start : start + most]."""
    own = sorted(paths)
    return own[start:] if most is None else own[start : start + most]


def files(pattern: str, start: int = 0, most: int | None = None) -> list[str]:
    """Files of a local pattern; give a pattern to Spark's readers themselves for other stores."""
    return sorted_slice(glob.glob(pattern), start, most)


def listing(spark: SparkSession, pattern: str, start: int = 0, most: int | None = None) -> list[str]:
    """sorted_slice of the files that match a pattern in any store, by Hadoop's file systems."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted_slice([f.getPath().toString() for f in found], start, most)


def _checked(paths: list[str] | str) -> list[str]:
    own = [paths] if isinstance(paths, str) else list(paths)
    for p in own:
        if p.endswith(UNREADABLE):
            raise ValueError(f"{os.path.basename(p)}: this compression can't be read")
    return own


def parquet(spark: SparkSession, paths: list[str] | str, columns: list[str] | None = None, text: str | None = None, rows_per_file: int | None = None) -> DataFrame:
    """Parquet files with ``_file``; files without the ``text`` column give null texts. ``rows_per_file`` takes the first rows of each file."""
    df = spark.read.option("mergeSchema", "true").parquet(*([paths] if isinstance(paths, str) else paths))
    if text and text not in df.columns:
        df = df.withColumn(text, F.lit(None).cast("string"))
    own = df.select(*(columns or df.columns), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")) if rows_per_file else df.select(*(columns or df.columns), F.col("_metadata.file_path").alias("_file"))
    return first_rows(own, "_file", "_row", rows_per_file).drop("_row") if rows_per_file else own


def json_lines(spark: SparkSession, paths: list[str] | str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines, plain or compressed by gz, bz2 or zst; malformed lines are dropped, a missing key is null. Without a schema, that of all keys is inferred."""
    own = _checked(paths)
    if schema is None:
        found = spark.read.option("mode", "DROPMALFORMED").json(own).schema
        schema = T.StructType([f for f in found if f.name != "_corrupt_record"])
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(own)


def json_rows(spark: SparkSession, paths: list[str] | str, schema: str, rows_per_file: int | None = None) -> DataFrame:
    """(path, file_idx, row_idx, *schema): rows of JSON-lines files, numbered from 0 among the valid lines of their file; ``rows_per_file`` counts valid lines, too.

    file_idx is the place of the file among all in order. A file is numbered in one task's sorted run, so a huge one is better split beforehand.
    """
    known = T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(schema)
    read = spark.read.text(_checked(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"), "value")
    bad = T.StructType([*known.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = read.where(F.trim("value") != "").withColumn("_row", F.from_json("value", bad)).where("_row._corrupt_record IS NULL AND _row IS NOT NULL").drop("value")
    place = F.row_number().over(Window.partitionBy("path").orderBy("_block", "_line")) - 1
    own = parsed.withColumn("row_idx", place)
    own = own if rows_per_file is None else own.where(F.col("row_idx") < rows_per_file)
    files = spark.read.format("binaryFile").load(paths).select("path").distinct().withColumn("file_idx", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("path")) - 1)
    files = files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "file_idx")
    return own.withColumn("path", F.regexp_replace("path", "^file:/+", "file:///")).join(files, "path").select("path", "file_idx", "row_idx", *[F.col(f"_row.{f.name}").alias(f.name) for f in known.fields])


def random_windows(tokens: DataFrame, ids: str, key: str, length: int, number: int, seed: int = 42) -> DataFrame:
    """(key, draw, start, window): for each row ``number`` windows of ``length`` ids whose starts a hash draws, with repeats; rows with fewer ids give none."""
    draws = F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
    own = tokens.where(F.size(ids) >= length).select(key, draws.alias("draw"), ids)
    digits = F.substring(F.sha1(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.col("draw").cast("string"))), 1, 12)
    start = F.pmod(F.conv(digits, 16, 10).cast("long"), (F.size(ids) - length + 1).cast("long")).cast("int")
    return own.withColumn("start", start).select(key, "draw", "start", F.slice(ids, F.col("start") + 1, length).alias("window"))


def text_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, line)."""
    return spark.read.text(_checked(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def whole_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, text): one row for each file that has bytes; Spark's file index leaves out those without."""
    return spark.read.text(_checked(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def empty_files(names: DataFrame, path: str) -> DataFrame:
    """(name): those of ``names`` that are files without bytes in the folder ``path``, which Spark's file index leaves out; the tasks ask the store."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column("name").to_pylist()
            infos = [fs.get_file_info(name) for fs, name in (_opened(f"{path}/{n}") for n in own)]
            yield pa.RecordBatch.from_pydict({"name": pa.array([n for n, i in zip(own, infos, strict=True) if i.is_file and i.size == 0], pa.string())})

    return names.select("name").mapInArrow(run, "name string")


def cdx_urls(lines: DataFrame, column: str = "line", drop_robots: bool = True) -> DataFrame:
    """(url): of index lines ``key timestamp {json}``; lines without an object or url are dropped, and robots.txt files if asked."""
    body = F.when(F.instr(column, "{") > 0, F.substr(F.col(column), F.instr(column, "{")))
    url = F.from_json(body, "url string")["url"]
    own = lines.select(url.alias("url")).where(F.col("url").isNotNull())
    return own.where(~F.col("url").endswith("/robots.txt")) if drop_robots else own


def cdx(spark: SparkSession, paths: list[str] | str, drop_robots: bool = True) -> DataFrame:
    return cdx_urls(text_lines(spark, paths), "line", drop_robots)


#: Token ids that a task reads at a time.
STRETCH = 1 << 20


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """A file's store, as pyarrow knows it, and its name there."""
    folder, _, name = (path if "://" in path else path.replace(":", "://", 1)).rpartition("/")
    fs, root = pafs.FileSystem.from_uri(quote(folder, safe="/:@"))
    return fs, f"{root}/{name}"


def _known_store(files: DataFrame) -> bool:
    """Whether tasks can open these files themselves; only Spark's readers reach every store."""
    try:
        return (one := files.select("path").first()) is None or _opened(one["path"])[0] is not None
    except (pa.ArrowException, OSError, ValueError):
        return False


def _stretches(path: str, length: int) -> Iterator[np.ndarray]:
    """The ids of a token file in order, a whole number of windows of ``length`` at a time; half an id at its end is none."""
    fs, name = _opened(path)
    wanted = 2 * length * max(1, STRETCH // length)
    with fs.open_input_stream(name, compression=None) as f:
        while raw := b"".join(_read(f, wanted)):
            yield np.frombuffer(raw, "<u2", len(raw) // 2).astype(np.int32)


def _read(f: pa.NativeFile, wanted: int) -> Iterator[bytes]:
    while wanted and (part := f.read(wanted)):
        wanted -= len(part)
        yield part


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for path in itertools.chain.from_iterable(b.column("path").to_pylist() for b in batches):
        first = 0
        for ids in _stretches(path, length):
            n = -(-len(ids) // length)
            lists = pa.ListArray.from_arrays(pa.array(np.minimum(np.arange(n + 1) * length, len(ids)), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(np.arange(first, first + n), pa.int32()), lists], names=["path", "window", "tokens"])
            first += n


def token_windows(spark: SparkSession, paths: list[str] | str, length: int) -> DataFrame:
    """(path, window, tokens): consecutive windows of unsigned 16-bit token files, those of a file in order in one partition.

    Tasks read STRETCH ids at a time; in a store that pyarrow doesn't know, Spark reads each file whole.
    """
    files = spark.read.format("binaryFile").load(paths)
    if _known_store(files):
        return files.select("path").mapInArrow(lambda it: _windows(it, length), "path string, window int, tokens array<int>")
    data = files.select("path", "content")
    own = data.select("path", F.posexplode(F.sequence(F.lit(0), (F.length("content") / 2 - 1).cast("int"), F.lit(length))).alias("window", "at"), "content")
    one = lambda i: F.conv(F.hex(F.concat(F.substring(F.col("_part"), i * 2 + 2, 1), F.substring(F.col("_part"), i * 2 + 1, 1))), 16, 10).cast("int")
    cut = own.select("path", "window", F.substr("content", F.col("at") * 2 + 1, F.lit(2 * length)).alias("_part"))
    return cut.select("path", "window", F.transform(F.sequence(F.lit(0), (F.length("_part") / 2 - 1).cast("int")), one).alias("tokens"))


def _comma_digits() -> np.ndarray:
    """For each 16-bit id a comma and its decimal digits, filled up by zeros."""
    return np.frombuffer(b"".join(f",{i}".encode().ljust(6, b"\0") for i in range(1 << 16)), np.uint8).reshape(-1, 6)


def _digests(pairs: Iterable[tuple[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    digits = _comma_digits()
    for path, own in itertools.groupby(pairs, key=lambda x: x[0]):
        n, digest = 0, hashlib.md5()
        for _, ids in own:
            for at in range(0, len(ids), STRETCH):
                marks = digits[ids[at : at + STRETCH]].ravel()
                digest.update(memoryview(marks[marks != 0])[0 if n else 1 :])
                n += len(ids[at : at + STRETCH])
        yield pa.RecordBatch.from_pylist([{"path": path, "n": n, "digest": digest.hexdigest()}])


def token_digests(spark: SparkSession, paths: list[str] | str, length: int) -> DataFrame:
    """(path, n, digest): the number of a token file's ids, and the MD5 of all of them in decimal, joined by commas. Windows are taken one after another, so no file is held whole where tasks can read it."""
    files = spark.read.format("binaryFile").load(paths)
    if _known_store(files):
        return files.select("path").mapInArrow(lambda it: _digests((p, ids) for b in it for p in b.column("path").to_pylist() for ids in _stretches(p, length)), "path string, n long, digest string")
    bound_batches(spark)
    found = token_windows(spark, paths, length).select("path", "tokens")
    return found.mapInArrow(lambda it: _digests((p, np.asarray(ids, np.int32)) for b in it for p, ids in zip(b.column("path").to_pylist(), b.column("tokens").to_pylist(), strict=True)), "path string, n long, digest string")
