"""Findings of round 2: memory of whole-corpus queries, and texts that are empty, blank or null, against SQL and plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import pytest

from loamsift.functions import text
from loamsift.operators import near_dup
from loamsift.plans import catalog, catalog_corpus  # noqa: F401  (both register queries)
from loamsift.sources import readers, sinks


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shingle_counts_hold_no_arrays_of_strings(spark, sf):
    texts = ["a b c d e f", "A b, c d e f", "b c", "", None, "é x", "a a a a a a a a"]
    want = Counter()
    for t in texts:
        w = text.normalize_text(t or "").split()
        for g in {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set():
            want[int.from_bytes(hashlib.sha1(g.encode()).digest()[:8], "little", signed=True)] += 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.number: r.n for r in near_dup.shingle_counts(docs, near_dup.Settings()).collect()} == want
    query = catalog.QUERIES["shingle_hash"](spark, sf)
    assert "Generate" not in plan_of(query)  # no text's shingles as an array of strings
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(6 << 20)


def test_token_files_are_digested_as_streams(spark, tmp_path):
    rows = [("s0", 0, [1, 2]), ("s0", 1, []), ("s0", 2, None), ("s 1", 3, list(range(65_536)))]
    tokens = spark.createDataFrame(rows, "shard string, place int, ids array<int>")
    path = str(tmp_path / "bin")
    sinks.write_tokens(sinks.token_bytes(tokens), path)
    want = {"s0": [1, 2, 50_256, 50_256], "s 1": [*range(65_536), 50_256]}
    found = readers.token_digests(spark, path, 1_000)
    assert {r.path.rsplit("/", 1)[1]: (r.n, r.digest) for r in found.collect()} == {f"{k}.bin": (len(v), hashlib.md5(",".join(map(str, v)).encode()).hexdigest()) for k, v in want.items()}
    windows = readers.token_windows(spark, path, 1_000).where("path LIKE '%1.bin'").orderBy("window").collect()
    assert [r.window for r in windows] == list(range(66)) and [x for r in windows for x in r.tokens] == want["s 1"]
    readers._known_store, known = lambda files: False, readers._known_store  # a store that only Spark reads
    try:
        assert sorted(readers.token_digests(spark, path, 1_000).collect()) == sorted(found.collect())
    finally:
        readers._known_store = known
    sinks.write_tokens(sinks.token_bytes(tokens.limit(0)), str(tmp_path / "none"))
    assert readers.token_digests(spark, str(tmp_path / "none"), 1_000).count() == 0


def test_token_files_collect_no_shard(spark, sf):
    plan = plan_of(catalog.QUERIES["token_files"](spark, sf))
    assert "collect_list" not in plan and "Exchange" not in plan


ODD = ["", "", " ", "\n", " \n\t ", "\u00a0", "\u3000\n", None, None, "the", "The THE of", "?", "...", "\u65e5\u672c\u8a9e", "the  of\r\nand", "this was it"]
#: Queries that judge empty texts as any other, as their SQL does.
JUDGED = ["content_label_counts", "dolma_quality", "gopher_failed_checks", "lexicon_content", "lexicon_language", "lexicon_quality", "lexicon_quality_filter", "pipeline_lexicon", "rejections_by_window", "survivors_copied"]


@pytest.fixture(scope="module")
def odd(spark, sf, tmp_path_factory):
    """The smallest documents and odd ones."""
    where = tmp_path_factory.mktemp("odd")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [(1_000 + i, t, "en", f"src{i}", 0) for i, t in enumerate(ODD)]
    docs.union(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{where}/documents.parquet")
    return str(where)


@pytest.mark.parametrize("name", JUDGED)
def test_odd_texts(spark, odd, name):
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{odd}/documents.parquet/*.parquet')")
        found = c.execute(catalog.ORACLES[name])
        names, want = [d[0] for d in found.description], found.fetchall()
    got = catalog.QUERIES[name](spark, odd).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


#: A capital I with a dot is an i in SQL's lower case; each text has listed words that are found only so, and that change its label.
DOTTED = ["THİS İT was", "the İt İt", "to wİth wİth", "the dİe dİe", "İ", "İthe", "Kthe thiſ", None, ""]


@pytest.mark.parametrize("name", ["lexicon_content", "content_label_counts", "dolma_quality", "lexicon_language", "lexicon_quality", "lexicon_quality_filter"])
def test_dotted_capital_i(spark, tmp_path, name):
    rows = [(i, t, "tr", "odd", 0) for i, t in enumerate(DOTTED)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        found = c.execute(catalog.ORACLES[name])
        names, want = [d[0] for d in found.description], found.fetchall()
    got = catalog.QUERIES[name](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
