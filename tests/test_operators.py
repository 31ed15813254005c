from __future__ import annotations

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from loamsift.functions import text
from loamsift.operators import classify, line_dedup, matching, near_dup, reports, sampling, seed_corpus
from loamsift.operators.components import components
from loamsift.plans import curation
from loamsift.sources import readers, sinks, warc
from loamsift.streaming import streams


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_line_dedup(spark):
    df = docs(spark, "a\nb\n", "b\nc", "", None, "d\n\nd")
    none = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert none == {0: "a", 1: "c", 2: "", 3: "", 4: ""}
    first = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, keep="first").collect()}
    assert first == {0: "a\nb\n", 1: "c", 2: "", 3: "", 4: "d"}
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(df, keep="last")


def brute_groups(texts, s):
    sets = []
    for t in texts:
        w = text.normalize_text(t).split()
        sets.append({" ".join(w[i : i + s.ngrams]) for i in range(len(w) - s.ngrams + 1)} or ({" ".join(w)} if w else set()))
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (not a and not b) or (a | b and len(a & b) / len(a | b) >= s.threshold):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def test_near_duplicates_and_chains(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(8):
        base = rng.choices(words, k=80)
        texts.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            copy[rng.randrange(80)] = "edit"
            texts.append(" ".join(copy))
    texts += ["", "", "short", "Short!", "  "]
    s = near_dup.Settings(num_hashes=256, num_bands=64, threshold=0.5, max_words=None)
    found = near_dup.find(docs(spark, *texts), s)
    got = [r.component for r in found.membership.orderBy("id").collect()]
    assert got == brute_groups(texts, s)
    assert found.skipped_buckets().count() == 0
    kept = near_dup.drop_near_duplicates(docs(spark, *texts), s)
    assert {r.doc_id for r in kept.collect()} == set(got)


def test_near_dup_links_large_families(spark):
    """Over 5,000 different near copies, whose buckets the former default skipped."""
    base = " ".join(f"w{i}" for i in range(200))
    texts = [f"{base} edit{i}" for i in range(6000)]
    found = near_dup.find(docs(spark, *texts, "another text of its own"), near_dup.Settings())
    assert found.keep().count() == 2
    assert found.skipped_buckets().count() == 0


def test_near_dup_stars_give_the_components_of_all_pairs(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(40)] = f"edit{i}"
        texts.append(" ".join(own))
    for threshold in (0.5, 0.8):
        s = near_dup.Settings(num_hashes=32, num_bands=32, threshold=threshold, star_from=2)
        found = near_dup.find(docs(spark, *texts), s)
        whole = {r.node: r.component for r in components(found.pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))).collect()}
        got = {r.id: r.component for r in found.membership.collect()}
        assert got == {i: whole.get(i, i) for i in range(120)}
        assert [got[i] for i in range(120)] == brute_groups(texts, s)


def test_near_dup_reads_whole_texts(spark):
    """Equal for 10,000 words, then different for twice as many."""
    same = " ".join(f"w{i}" for i in range(10_000))
    tail = lambda x: " ".join(f"{x}{i}" for i in range(20_000))
    kept = near_dup.find(docs(spark, f"{same} {tail('a')}", f"{same} {tail('b')}")).keep()
    assert kept.count() == 2


def test_near_dup_production_queries(spark, tmp_path):
    from loamsift.plans import catalog

    texts = [" ".join(f"{x}{i}" for i in range(300)) + f" edit{n}" for x in "abc" for n in range(3)] + ["", "short", "Short!"]
    docs(spark, *texts).write.parquet(str(tmp_path / "documents.parquet"))
    want = brute_groups(texts, near_dup.Settings())
    got = {r.doc_id: r.component for r in catalog.QUERIES["near_dup_production_components"](spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert {r.doc_id for r in catalog.QUERIES["near_dup_production_keep"](spark, str(tmp_path)).collect()} == set(want)


def test_near_dup_settings():
    with pytest.raises(ValueError):
        near_dup.Settings(num_hashes=10, num_bands=3)
    with pytest.raises(ValueError):
        near_dup.Settings(max_bucket=1)


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 7)] + [(1, i) for i in range(2, 60)] + [(500, 501), (501, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(1, 60)} == {1} and got[501] == 500


def test_jaccard(spark):
    df = spark.createDataFrame([([], []), (["a"], []), (["a", "b"], ["b", "c"])], "x array<string>, y array<string>")
    assert [r[0] for r in df.select(near_dup.jaccard(F.col("x"), F.col("y"))).collect()] == [1.0, 0.0, 1 / 3]


def test_budget_ends_on_a_document(spark):
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate([4, 6, 0, 5, 5])], "shard string, doc_id long, n long")
    out = matching.within_budget(df, "shard", "doc_id", "n", F.lit(20)).collect()
    assert sum(r.taken for r in out) == 20 and not any(r.truncated for r in out)
    out = matching.within_budget(df, "shard", "doc_id", "n", F.lit(7)).orderBy("place").collect()
    assert sum(r.taken for r in out) == 7 and [r.truncated for r in out][:-1] == [False] * (len(out) - 1)
    short = matching.shortfall(matching.within_budget(df, "shard", "doc_id", "n", F.lit(99)), "shard", spark.createDataFrame([("s", 99), ("t", 1)], "shard string, budget long"))
    assert sorted(tuple(r) for r in short.collect()) == [("s", 99, 20), ("t", 1, 0)]


def test_verify_and_shards(spark):
    side = lambda *rows: spark.createDataFrame(rows, "shard int, tokens long, bytes long")
    expected = spark.createDataFrame([(0,), (1,), (2,)], "shard int")
    out = matching.verify_matched(expected, side((0, 5, 10), (1, 5, 10)), side((0, 5, 10), (1, 6, 11)))
    assert sorted(tuple(r) for r in out.collect()) == [(1, "tokens differ"), (1, "unfiltered: bytes"), (2, "filtered: missing"), (2, "unfiltered: missing")]
    assert matching.shard_numbers("0-2,5, 7-7") == [0, 1, 2, 5, 7]
    files = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "shard int, path string")
    assert [tuple(r) for r in matching.one_file_per_shard(files).collect()] == [(1, 2)]


def test_first_rows_and_permutation(spark):
    df = spark.createDataFrame([(f, i) for f in "ab" for i in range(5)], "file string, row long")
    assert sorted(tuple(r) for r in sampling.first_rows(df, "file", "row", 2).collect()) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    placed = sampling.permuted(df, "file", "row").collect()
    assert sorted(r.place for r in placed if r.file == "a") == [1, 2, 3, 4, 5]


def test_reports(spark):
    df = spark.createDataFrame([(1, None), (2, "language"), (3, "gopher"), (4, "language")], "doc_id long, removed_by string")
    rows = {r.stage: (r.docs_in, r.removed, r.pct) for r in reports.funnel(df, ["language", "gopher"]).collect()}
    assert rows == {"language": (4, 2, 50.0), "gopher": (2, 1, 50.0)}
    assert reports.funnel(df.limit(0), ["language"]).first().pct == 0.0
    acc = {r.label: (r.n, r.accuracy) for r in reports.accuracy(spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "label string, p string"), "label", "p").collect()}
    assert acc == {"a": (2, 0.5), "b": (2, 1.0), None: (4, 0.75)}
    curve = spark.createDataFrame([(0.0, 4.0), (10.0, 2.0), (20.0, 1.0)], "x double, y double")
    assert reports.crossing(curve, "x", "y", 3.0).first().crossing == 5.0
    assert reports.http_status(spark.createDataFrame([(200,), (404,)], "status int")).where("success").count() == 1
    nll = spark.createDataFrame([(0.6931471805599453, 1)], "nll double, b long")
    assert abs(reports.bits_per_byte(nll, "nll", "b").first()[0] - 1) < 1e-12
    total = spark.createDataFrame([(10, 5, 2_000_000)], "rows long, kept long, chars long")
    assert reports.throughput(total, 2.0).first().rows_per_second == 5.0


def test_classifiers(spark):
    en, de = "the cat and the dog of that house with them ", "der hund und die katze in dem haus mit ihnen "
    model = classify.fit([en * 3, de * 3], ["en", "de"])
    df = docs(spark, en, de, "", None)
    got = [tuple(r.f) for r in df.select("doc_id", classify.identify_language(spark, model, F.col("text")).alias("f")).orderBy("doc_id").collect()]
    assert got[0][0] == "en" and got[1][0] == "de" and got[2] == got[3] == ("unknown", 0.0)
    quality = classify.fit(["good prose here", "BUY NOW!!"], ["1", "0"])
    got = [r.f.label for r in df.select("doc_id", classify.classify_quality(spark, quality, F.col("text")).alias("f")).orderBy("doc_id").collect()]
    assert got[2] == got[3] == "negative"


def test_classifiers_read_whole_texts(spark):
    """The second half of a text counts where it starts after 10,000 characters."""
    en, de = "the cat and the dog of that house with them ", "der hund und die katze in dem haus mit ihnen "
    model = classify.fit([en, de], ["en", "de"])
    long = "a" * 10_000 + " " + de
    df = docs(spark, long)
    f = lambda *most: classify.identify_language(spark, model, F.col("text"), *most)
    whole, cut = df.select(f().alias("whole"), f(10_000).alias("cut")).first()
    assert whole.label == "de" and whole.score > cut.score
    toxic = classify.fit(["kind words of a friend", "vile slur"], ["0", "1"])
    bad = docs(spark, "kind words of a friend " * 500 + "vile slur " * 3, "kind words of a friend " * 500)
    scores = [r.f.score if r.f.label == "toxic" else 1 - r.f.score for r in bad.select("doc_id", classify.classify_content(spark, toxic, F.col("text"), "toxic").alias("f")).orderBy("doc_id").collect()]
    assert scores[0] > scores[1]


def test_curation(spark):
    good = "The story of that house and the people who have lived with it. " * 20
    df = spark.createDataFrame([(0, good + " mail me a@b.co", "en"), (1, good, "de"), (2, "short", "en"), (3, "", "en"), (4, None, "en"), (5, f"<html><body><p>{good}</p></body></html>", "en")], "doc_id long, text string, lang string")
    plan = curation.Plan(language_column="lang")
    got = {r.doc_id: r.removed_by for r in curation.decisions(df, plan).collect()}
    assert got == {0: None, 1: "language", 2: "gopher", 3: "empty_text", 4: "missing_text", 5: None}
    out = {r.doc_id: r.text for r in curation.curated(df, plan).collect()}
    assert set(out) == {0, 5} and "|||EMAIL_ADDRESS|||" in out[0] and "<p>" not in out[5]
    kept = curation.curated(df, curation.Plan(language_column="lang", drop_empty=False))
    assert {r.doc_id for r in kept.collect()} == {0, 3, 5}
    near = curation.Plan(language_column="lang", mask_pii=False, near_duplicates=near_dup.Settings())
    assert {r.doc_id for r in curation.curated(df, near).collect()} == {0}


def test_json_lines(spark, tmp_path):
    p = tmp_path / "a.jsonl.gz"
    with gzip.open(p, "wt") as f:
        f.write('{"text": "x", "n": 1}\n{broken\n{"text": null}\n')
    assert [tuple(r) for r in readers.json_lines(spark, str(p), "text string, n int").collect()] == [("x", 1), (None, None)]
    df = readers.json_lines(spark, str(p))
    assert sorted(df.columns) == ["n", "text"]
    sinks.write_json_lines(df, str(tmp_path / "out"))
    assert readers.json_lines(spark, str(tmp_path / "out"), "text string, n int").count() == 2
    with pytest.raises(ValueError):
        readers.json_lines(spark, "a.jsonl.xz")


ARCHIVE = (
    b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\nContent-Length: 32\r\n\r\nHTTP/1.1 200 OK\r\nA: b\r\n\r\n<p>x</p\r\n\r\n"
    b"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: http://b/\r\nContent-Length: 3\r\n\r\n\xc3\xa9!\r\n\r\n"
)


def test_warc_and_wet(spark, tmp_path):
    with gzip.open(tmp_path / "x.warc.gz", "wb") as f:
        f.write(ARCHIVE)
    rows = warc.warc(spark, str(tmp_path)).collect()
    assert [r.warc_type for r in rows] == ["warcinfo", "response", "conversion"]
    assert rows[1].http_headers["A"] == "b" and rows[1].content == "<p>x</p"
    assert [tuple(r) for r in warc.wet(spark, str(tmp_path)).collect()] == [("é!", "http://b/")]
    stored = spark.read.format("binaryFile").load(str(tmp_path))
    assert warc.parse(stored).count() == 3


def test_files_by_name(spark, tmp_path):
    """Verbatim copies, empty files, lines with their closing break, zst lines of empty and full tables, metrics."""
    path = str(tmp_path / "out")
    files = spark.createDataFrame([("a", b"\x00\xff"), ("b", b""), ("c", None), (None, b"x")], "name string, body binary")
    assert sinks.write_files(files, path) == 2 and sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")) == ["a", "b"]
    assert (tmp_path / "out" / "a").read_bytes() == b"\x00\xff" and (tmp_path / "out" / "b").read_bytes() == b""
    assert sinks.copy_survivors(files, spark.createDataFrame([("b",), ("b",), ("z",)], "name string"), str(tmp_path / "kept")) == 1
    assert sinks.write_lines(spark.createDataFrame([("x", "1\n2"), ("y", "")], "name string, text string"), str(tmp_path / "lines")) == 2
    assert (tmp_path / "lines" / "x").read_text() == "1\n2\n" and (tmp_path / "lines" / "y").read_text() == ""
    sinks.write_json_lines(files.select("name").limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists() or not [p for p in (tmp_path / "none").iterdir() if p.name.startswith("part")]
    sinks.write_metrics(spark, {"b": 1, "a": [2]}, str(tmp_path / "m" / "x.json"))
    assert json.loads((tmp_path / "m" / "x.json").read_text()) == {"a": [2], "b": 1}


def test_failed_writes_leave_no_file(spark, tmp_path):
    with pytest.raises(ZeroDivisionError), sinks._whole_file(f"file://{tmp_path}", "x") as f:
        f.write(b"half")
        1 / 0
    assert list(tmp_path.iterdir()) == []


def test_folder_job(spark, tmp_path):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words stand here now and then"), (4, None)]
    spark.createDataFrame(rows[:2], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame(rows[2:], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = near_dup.folder_job(spark, str(tmp_path / "in"), None, count_only=True)
    assert (got["rows"], got["kept"], got["removed"]) == (4, 2, 2) and set(got["seconds"]) == {"find"}
    assert sorted((r.rows, r.kept) for r in got["kept_by_file"].collect()) == [(2, 1), (2, 1)]
    near_dup.folder_job(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3]


def test_seed_limits(spark):
    rows = [(1, 10, "x  y"), (2, seed_corpus.MAX_RAW_BYTES + 1, "x"), (3, 10, "a" * (seed_corpus.MAX_TEXT_CHARS + 1)), (4, 10, " "), (5, 10, None)]
    pair = lambda a, b: F.struct(F.lit(a).alias("label"), F.lit(b).alias("score"))
    df = spark.createDataFrame(rows, "id int, n int, text string")
    run = lambda lang, nsfw, toxic: {r.id: r.removed_by for r in seed_corpus.positive_decisions(df, F.col("n"), F.col("text"), pair("en", lang), pair("nsfw", nsfw), pair("toxic", toxic)).collect()}
    assert run(0.5, 0.69, 0.69) == {1: None, 2: "too_large", 3: "too_large", 4: "empty", 5: "empty"}
    assert run(0.49, 1.0, 1.0)[1] == "language" and run(0.5, 0.7, 0.7)[1] == "nsfw" and run(0.5, 0.6, 0.7)[1] == "toxic"
    assert [r.value for r in seed_corpus.negatives(df.where("id <> 3"), "id", number=1).collect()] == ["__label__negative x  y"]


def test_many_components_agree_with_few(spark):
    from loamsift.operators import components as K

    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, i) for i in range(400, 460)] + [(i, i + 1) for i in range(500, 540)]
    df = spark.createDataFrame(edges, "u long, v long")
    stars, once = (sorted((r.node, r.component) for r in K.components(df, few).collect()) for few in (0, 10_000))
    assert stars == once and (459, min(c for n, c in once if n == 400)) in once


def test_files_and_sinks(spark, tmp_path):
    for n in ("b", "a", "c"):
        (tmp_path / f"{n}.txt").write_text(f"{n}1\n{n}2\n")
    assert [p[-5:] for p in readers.files(str(tmp_path / "*.txt"), 1, 1)] == ["b.txt"]
    assert readers.text_lines(spark, str(tmp_path)).count() == 6
    assert readers.whole_files(spark, str(tmp_path)).count() == 3
    assert sinks.output_name("/x/a.jsonl.zst") == "a.parquet" and sinks.output_name("a.parquet", "jsonl") == "a.jsonl.zst"
    tokens = spark.createDataFrame([("s0", 1, [1, 2]), ("s0", 2, [65535]), ("s1", 1, [])], "shard string, place int, ids array<int>")
    sinks.write_tokens(sinks.token_bytes(tokens), str(tmp_path / "bin"))
    assert (tmp_path / "bin" / "s0.bin").read_bytes() == b"\x01\x00\x02\x00\x50\xc4\xff\xff\x50\xc4"
    windows = readers.token_windows(spark, str(tmp_path / "bin" / "s0.bin"), 3).orderBy("window").collect()
    assert [r.tokens for r in windows] == [[1, 2, 50256], [65535, 50256]]
    sinks.write_parquet(tokens.limit(0), str(tmp_path / "empty"))
    assert spark.read.parquet(str(tmp_path / "empty")).columns == tokens.columns
    own = readers.parquet(spark, str(tmp_path / "empty"), text="text")
    assert "text" in own.columns


def test_streams(spark, tmp_path):
    good = "The story of that house and the people who have lived with it. " * 20
    rows = spark.createDataFrame([(good, "2024-01-01 00:00:00"), (good, "2024-01-01 00:01:00"), ("bad", "2024-01-01 00:02:00")], "text string, at string").withColumn("at", F.col("at").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = streams.first_seen(streams.curate(stream), "at").writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("kept").count() == 1 == streams.first_seen(streams.curate(rows), "at").count()
    assert streams.rejections(rows, "at").agg(F.sum("count")).first()[0] >= 1
