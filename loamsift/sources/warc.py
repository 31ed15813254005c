"""WARC and WET archives as a data source: ``spark.read.format("warc").load(path)``.

Records are parsed as a stream; a .gz archive may hold a member for each record. One task reads a file, since neither form can be split.
"""

from __future__ import annotations

import glob
import gzip
import os
from collections.abc import Iterator
from io import BufferedReader

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "warc_type string, url string, warc_headers map<string,string>, http_headers map<string,string>, content string, content_bytes binary, content_length long"


def records(stream: BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; a record cut short ends the stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        for raw in iter(stream.readline, b""):
            if raw in (b"\r\n", b"\n"):
                break
            name, _, value = raw.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        size = headers.get("Content-Length", "")
        if not size.isdigit():
            continue
        block = stream.read(int(size))
        if len(block) < int(size):
            return
        yield headers, block


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers and body, which an empty line parts (CRLF or LF)."""
    for mark in (b"\r\n\r\n", b"\n\n"):
        head, found, body = block.partition(mark)
        if found:
            lines = head.decode("latin-1").splitlines()
            named = (x.partition(":") for x in lines[1:])
            return {"status_line": lines[0] if lines else ""} | {k.strip(): v.strip() for k, c, v in named if c}, body
    return {}, block


def row(headers: dict[str, str], block: bytes) -> tuple | None:
    kind = headers.get("WARC-Type", "")
    if kind not in ("response", "request", "warcinfo", "conversion"):
        return None
    http, body = split_http(block) if kind in ("response", "request") else ({}, block)
    return (kind, headers.get("WARC-Target-URI"), headers, http, body.decode("utf-8", "replace"), body, len(body))


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[_File]:
        found = sorted(glob.glob(os.path.join(self.path, "*")) if os.path.isdir(self.path) else glob.glob(self.path))
        return [_File(p) for p in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        with (gzip.open if partition.path.endswith(".gz") else open)(partition.path, "rb") as f:
            for headers, block in records(f):
                made = row(headers, block)
                if made is not None:
                    yield made


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def warc(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").load(path)


def wet(spark: SparkSession, path: str) -> DataFrame:
    """(text, url) of conversion records."""
    return texts(warc(spark, path))


def archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of archives in any store that Spark reads, whole files at a time."""
    return parse(spark.read.format("binaryFile").load(path))


def texts(found: DataFrame) -> DataFrame:
    """(text, url) of the conversion records among records."""
    return found.where("warc_type = 'conversion'").select(F.col("content").alias("text"), "url")


def parse(archives: DataFrame, content: str = "content") -> DataFrame:
    """Records of uncompressed or gzipped archives that are rows of bytes, as from ``binaryFile``, which reads any store."""

    def run(frames):
        import io

        import pandas as pd

        for df in frames:
            for data in df[content]:
                stream = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
                made = [r for h, b in records(stream) if (r := row(h, b)) is not None]
                if made:
                    yield pd.DataFrame(made, columns=["warc_type", "url", "warc_headers", "http_headers", "content", "content_bytes", "content_length"])

    return archives.select(content).mapInPandas(run, SCHEMA)
