"""Zstandard WARC archives: a writer and a reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself a Zstandard frame or raw.
Then each record is one frame, so records can be read one by one. Archives have a bounded size and stand in a shared
folder; Spark's binaryFile source lists and reads them, and each is decoded by one task.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamsift.llm import _common as C

MAGIC_DICTIONARY = 0x184D2A5D
MAGIC_FRAME = 0xFD2FB528
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 2 << 20
MAX_RECORD_BYTES = 1 << 30
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_one_line(v)}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return " ".join(str(value).split())


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block; raises WarcError on a malformed head or a length that doesn't fit."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("a record must start with its version and end its head with an empty line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"malformed header {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"{name} is missing")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError("the block's length differs from Content-Length")
    return headers, rest[:-4]


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=3).compress(dictionary)
    return struct.pack("<II", MAGIC_DICTIONARY, len(packed)) + packed


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, each decoded from a frame of its own."""
    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == MAGIC_DICTIONARY:
        size = struct.unpack_from("<I", data, 4)[0]
        raw = data[8 : 8 + size]
        if len(raw) != size:
            raise WarcError("the dictionary frame is cut short")
        if raw[:4] == struct.pack("<I", MAGIC_FRAME):
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=MAX_RECORD_BYTES)
        dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
        at = 8 + size
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    view = memoryview(data)
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0] if at + 4 <= len(data) else 0
        if magic & 0xFFFFFFF0 == 0x184D2A50 and at + 8 <= len(data):
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        if magic != MAGIC_FRAME:
            raise WarcError(f"no frame at byte {at}")
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            step = data[at : at + 65_536]
            if not step:
                raise WarcError("the last frame is cut short")
            parts.append(frame.decompress(step))
            at += len(step) - (len(frame.unused_data) if frame.eof else 0)
        yield b"".join(parts)


def write_archives(records: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """Write rows (page_id, url, payload, refers_to) as archives into ``folder``, which all executors can reach.

    A row whose refers_to is null becomes a response, else a revisit without payload that names the record it repeats. Each task trains a dictionary on its first
    ``SAMPLE_BYTES`` of records. A task writes under names of its own attempt and returns those, so what a lost or repeated attempt left is never read.
    Returns (path, n_records); it runs lazily.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        waiting: list[bytes] = []
        state: dict = {"coder": None, "dictionary": b"", "sink": None, "size": 0}
        finished: list[tuple[str, int]] = []

        def begin() -> None:
            if state["coder"] is None:
                try:
                    trained = zstandard.train_dictionary(DICTIONARY_BYTES, [r[:65_536] for r in waiting])
                    state["dictionary"] = trained.as_bytes()
                except zstandard.ZstdError:  # too few records
                    trained = None
                state["coder"] = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
            state["name"] = f"{uuid.uuid4().hex}.warc.zst"
            state["sink"], state["size"], state["n"] = fs.open_output_stream(f"{root}/{state['name']}", compression=None), 0, 0
            put(dictionary_frame(state["dictionary"]))

        def put(data: bytes) -> None:
            state["sink"].write(data)
            state["size"] += len(data)

        def end() -> None:
            if state["sink"] is not None:
                state["sink"].close()
                finished.append((f"{folder}/{state['name']}", state["n"]))
                state["sink"] = None

        def flush() -> None:
            for r in waiting:
                if state["sink"] is None:
                    begin()
                put(state["coder"].compress(r))
                state["n"] += 1
                if state["size"] >= ARCHIVE_BYTES:
                    end()
            waiting.clear()

        held = 0
        for batch in C.slices(batches, "payload"):
            for page, url, payload, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                waiting.append(page_record(page, url, payload.encode(), refers))
                held += len(waiting[-1])
                if held >= SAMPLE_BYTES:
                    flush()
                    held = 0
        flush()
        end()
        if finished:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in finished]), pa.array([n for _, n in finished], pa.int64())], names=["path", "n_records"])

    C.bound_batches(records.sparkSession)
    return records.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "path string, n_records long")


def page_record(page: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return build_record(headers, http if revisit else http + payload)


def _page_of(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


RECORD_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _records(archives: Iterator[bytes], keep_payload: bool) -> Iterator[pd.DataFrame]:
    for data in archives:
        out: list[tuple] = []
        size = 0
        for record in read_archive(data):
            row = _row(*parse_record(record), keep_payload)
            out.append(row)
            size += len(row[-1] or b"") + 200
            if size > C.SLICE_BYTES:
                yield _frame(out)
                out, size = [], 0
        yield _frame(out)


def read_archives(spark: SparkSession, paths: list[str] | str, keep_payload: bool = True) -> DataFrame:
    """Records of all archives in a folder of any store: decoded frame by frame, heads, lengths and digests checked."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _records((data for df in frames for data in df["content"]), keep_payload)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(paths).select("content").mapInPandas(run, RECORD_SCHEMA)


def read_written(written: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Records of the archives that ``write_archives`` returned (``written``, a written table), as in read_archives. Their paths stay in the table: the driver holds none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for path in df["path"]:
                fs, own = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(own) as f:
                    yield from _records(iter([f.read()]), keep_payload)

    return written.select("path").repartition(C.rows_per_partition(written, 1, 1 << 14)).mapInPandas(run, RECORD_SCHEMA)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir with its scheme: that of the default file system where the setting names none."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(C.scratch_dir(spark))
    uri = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri if "://" in uri else uri.replace(":", "://", 1)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    cols = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    df = pd.DataFrame(rows, columns=cols)
    return df.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def _row(headers: dict[str, str], block: bytes, keep: bool) -> tuple:
    http, mark, payload = block.partition(b"\r\n\r\n")
    if not mark or not http.startswith(b"HTTP/1."):
        raise WarcError("no HTTP head in the block")
    fields = dict(x.lower().split(b": ", 1) for x in http.split(b"\r\n")[1:])
    size, digest, kind = int(fields[b"content-length"]), headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise WarcError(f"{headers['warc-record-id']}: the payload differs from its length or digest")
    return (_page_of(headers["warc-record-id"]), headers.get("warc-target-uri", ""), kind, size, digest, _page_of(headers.get("warc-refers-to")), payload if keep and kind == "response" else None)


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): of equal payloads that of the largest page_id is kept, others refer to it.

    A null html is an empty payload. Payloads under ``min_bytes`` refer to none. Rows that repeat a page's id and payload are records of the same type;
    a null page_id yields to any other, and if all are null, all are responses. The join is by digest only of payloads that occur
    twice or more, and Spark splits its skewed keys; the digest counts are combined before they are shuffled.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    own = own.withColumn("_digest", F.when(F.octet_length("payload") >= min_bytes, F.unhex(F.sha1("payload"))))
    kept = own.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.max("page_id").alias("_kept"), F.count("*").alias("_n"))
    kept = kept.where("_n > 1").select("_digest", "_kept")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_kept")), F.col("_kept"))
    return own.join(kept, "_digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = mark_revisits(C.table(spark, sf_dir, "pages"))
    written = C.materialize(write_archives(records, shared_folder(spark)))
    return read_written(written, keep_payload=False).drop("payload", "url")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
k AS (SELECT b, max(page_id) AS kept FROM p GROUP BY b),
d AS (SELECT p.page_id, octet_length(p.b) AS n, sha1(p.b) AS h, k.kept FROM p JOIN k USING (b)),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: printf('%04d', (('0x' || substr(h, i, 1))::INT::BIT::VARCHAR)[29:32]::INT)), '') AS s FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    list_sum(list_transform(range(0, 5), lambda j: substr(s, (i * 5 + j + 1)::INT, 1)::INT * (16 >> j::INT)))::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM bits
"""
