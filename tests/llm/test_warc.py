from __future__ import annotations

import base64
import hashlib

import pytest
import zstandard

from loamsift.llm import _common as C
from loamsift.llm import warc_zstd as W


def run(spark, rows, min_bytes=0):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, extra string")
    folder = W.shared_folder(spark)
    found = C.materialize(W.write_archives(W.mark_revisits(pages, min_bytes), folder))
    if rows:
        assert sorted(W.read_archives(spark, folder).collect(), key=repr) == sorted(W.read_written(found).collect(), key=repr)
    return W.read_written(found)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark):
    rows = [(1, "http://a/", "<p>é</p>", None), (2, None, None, None), (3, "u\r\nX: y", "", None), (5, "u", "<p>é</p>", "z"), (5, "u", "<p>é</p>", "z"), (7, "u", "x" * 300_000, None), (None, "n", "<p>é</p>", None)]
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in run(spark, rows).collect()), key=repr)
    keep = {"<p>é</p>": 5, "": 3, "x" * 300_000: 7}
    want = []
    for i, _, h, _ in rows:
        h = h or ""
        revisit = i != keep[h]
        want.append((i, len(h.encode()), digest(h), "revisit" if revisit else "response", keep[h] if revisit else None, None if revisit else h.encode()))
    assert got == sorted(want, key=repr)


def test_small_payloads_stay_responses(spark):
    got = run(spark, [(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abcdef", None), (4, "u", "abcdef", None)], 5).collect()
    assert {r.page_id: r.record_type for r in got} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty_table(spark):
    assert run(spark, []).count() == 0


def frames(dictionary, records):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(dict_data=d)
    return [W.dictionary_frame(dictionary)] + [c.compress(r) for r in records]


RECORD = W.page_record(1, "u", b"payload", None)


def test_reader_takes_raw_and_packed_dictionaries_and_skips_frames():
    dictionary = b"WARC/1.1 payload Content-Length " * 40
    head, one, two = frames(dictionary, [RECORD, RECORD * 1])
    assert list(W.read_archive(head + one + two)) == [RECORD, RECORD]
    raw = W.struct.pack("<II", W.MAGIC_DICTIONARY, len(dictionary)) + dictionary
    assert list(W.read_archive(raw + one)) == [RECORD]
    other = W.struct.pack("<II", 0x184D2A50, 3) + b"abc"
    assert list(W.read_archive(raw + other + one)) == [RECORD]
    assert list(W.read_archive(frames(b"", [RECORD])[1])) == [RECORD]
    assert list(W.read_archive(b"")) == []


@pytest.mark.parametrize("spoil", [lambda d: d[:-3], lambda d: d + b"junk", lambda d: d[:6]])
def test_reader_rejects_cut_archives(spoil):
    data = b"".join(frames(b"WARC/1.1 payload " * 40, [RECORD]))
    with pytest.raises((W.WarcError, zstandard.ZstdError)):
        list(W.read_archive(spoil(data)))


@pytest.mark.parametrize(
    "record",
    [RECORD[:-1], RECORD + b"x", RECORD.replace(b"WARC/1.1", b"WARX/1.1"), RECORD.replace(b"Content-Length: 8", b"Content-Length: 7", 1) if b"Content-Length: 8" in RECORD else RECORD[:-4], RECORD.replace(b"WARC-Date", b"WARC-Dote"), RECORD.replace(b"WARC-Type: response", b"WARC-Type response")],
)
def test_records_are_validated(record):
    with pytest.raises(W.WarcError):
        W.parse_record(record)


def test_a_changed_payload_is_noticed():
    with pytest.raises(W.WarcError):
        W._row(*W.parse_record(RECORD.replace(b"payload\r\n", b"paylaod\r\n")), True)
