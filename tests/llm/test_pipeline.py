from __future__ import annotations

import random

import public_tokenizers
from brute import components, contamination, row_components, without_passages
from tokenizers import Tokenizer

import corpus_pipeline as P
from loamsift.llm import _common as C
from loamsift.llm import quality_nbsvm as Q
from loamsift.llm import suffix_dedup as S


def test_stages_against_brute_force(spark, sf):
    docs = C.table(spark, sf, "documents")
    labels, bench = C.table(spark, sf, "labels"), [tuple(r) for r in C.table(spark, sf, "benchmark").select("item_id", "text").collect()]
    names = [n for n, _ in P.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_strings", "benchmark_free", "packed"]
    held = {}
    for name, stage in P.STAGES:
        now = C.materialize(stage(spark, docs, sf))
        held[name] = now
        if name != "packed":
            assert now.columns == C.table(spark, sf, "documents").columns
            docs = now
    text = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    raw = text(C.table(spark, sf, "documents"))
    model = Q.train(Q.training_rows(C.table(spark, sf, "documents"), labels))
    good = {r.doc_id for r in Q.score(C.table(spark, sf, "documents"), model).where("predicted = 1").collect()}
    one = text(held["quality"])
    assert one == {i: t for i, t in raw.items() if i in good}
    two = text(held["near_duplicates"])
    assert two == {i: one[i] for i, _, c in components(list(one.items())) if i == c}
    three = text(held["repeated_strings"])
    assert three == {i: k.decode("utf-8", "ignore") for i, k in without_passages(list(two.items()), S.LENGTH, S.PASSAGE_BYTES, S.PASSAGE_WORDS)}
    four = text(held["benchmark_free"])
    assert four == {i: three[i] for i, _, _, _, _, bad, *_ in contamination(list(three.items()), bench) if not bad}
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r.doc_id: r.doc_tokens for r in held["packed"].collect()}
    assert sizes == {i: len(exact.encode(t, add_special_tokens=False).ids) + 1 for i, t in four.items()}


def test_run(spark, sf):
    assert P.run(spark, sf).groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def folder_of(spark, tmp_path, docs, labels, items):
    """Tables of the pipeline with nulls in every column, and columns whose names clash with those used inside."""
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, spans string, text_key string, node string, __spans string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return f"file://{tmp_path}", docs.columns


def test_odd_rows_through_all_stages(spark, tmp_path):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(4, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    bad, near, passage, item = "BUY now!!! ", prose(200), prose(52), prose(12)
    rows = [(i, prose(60)) for i in range(20)] + [(100 + i, bad * 30 + str(i)) for i in range(12)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (None, prose(30)), (None, None), (203, near), (204, near + " more"), (205, near), (206, prose(70)), (206, rows[3][1]), (207, prose(20_000))]
    rows += [(208, f"{prose(40)} {passage} {prose(9)}"), (209, f"{prose(9)} {passage} {prose(40)}"), (210, f"{prose(40)} {item} {prose(40)}"), (211, prose(44)), (211, rows[-1][1])]
    rows += [(212, same := prose(33)), (212, same)]
    labels = [(i, 1, None) for i in range(20)] + [(100 + i, 0, 1) for i in range(10)] + [(9_999, 1, 0), (None, 1, 0), (3, None, None)]
    items = [(1, item), (1, item), (2, None), (None, ""), (3, "zz yy xx")]
    path, columns = folder_of(spark, tmp_path, [(*r, None, None, None, None, None, None, None) for r in rows], labels, items)
    docs = C.table(spark, path, "documents")
    own = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    model = Q.train(Q.training_rows(docs, C.table(spark, path, "labels")))
    assert model.bias is not None and any(model.weights)
    good = {r.doc_id for r in Q.score(docs, model).where("predicted = 1").collect()}
    now = [r for r in rows if r[0] in good]
    for name, stage in P.STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, path))
        assert docs.columns == columns
        if name == "quality":
            rejected = {i for i, _ in rows} - {r.doc_id for r in docs.collect()}
            assert rejected and rejected <= {*range(100, 112), 200, 201}
            now = [(r.doc_id, r.text) for r in docs.collect()]
        elif name == "near_duplicates":
            named = [(i, t) for i, t in now if i is not None]
            first = {}
            for (i, t), (_, n, c) in zip(sorted(named, key=repr), sorted_components(named), strict=True):
                if n:
                    first.setdefault(c, set()).add((i, t))
            leave = {x for own_ in first.values() for x in own_ if x != min(own_)}
            now = [(i, t) for i, t in now if (i, t) not in leave]
            assert {203} == {i for i, t in now if t and near in t} and not {204, 205} & {i for i, _ in now}
        elif name == "repeated_strings":
            now = [(i, None if t is None else k.decode("utf-8", "ignore")) for (i, t), (_, k) in zip(now, without_passages(now, S.LENGTH, S.PASSAGE_BYTES, S.PASSAGE_WORDS), strict=True)]
            assert not any(passage in (t or "") for _, t in now) and any(i == 208 for i, _ in now)
        else:
            dirty = {i for i, _, _, _, _, hit, *_ in contamination(now, items) if hit}
            assert dirty == {210}
            now = [(i, t) for i, t in now if i not in dirty]
        assert own(docs) == sorted(now, key=repr), name
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = P.STAGES[-1][1](spark, docs, path).collect()
    assert sum(r.length for r in got) == sum(len(exact.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in now)
    assert P.run(spark, path).count() == len(got)


def sorted_components(rows):
    """row_components in the order of the sorted rows."""
    rows = sorted(rows, key=repr)
    number = [(j, t) for j, (_, t) in enumerate(rows)]
    found = {j: (n, c) for j, n, c in components(number)}
    assert sorted((rows[j][0], n, min(rows[m][0] for m in found if found[m][1] == c)) for j, (n, c) in found.items()) == row_components(rows)
    return [(rows[j][0], *found[j]) for j in range(len(rows))]


def test_empty_tables_through_all_stages(spark, tmp_path):
    path, columns = folder_of(spark, tmp_path, [], [], [])
    docs = C.table(spark, path, "documents")
    for name, stage in P.STAGES:
        docs = C.materialize(stage(spark, docs, path))
        assert docs.count() == 0 and (name == "packed" or docs.columns == columns)
    assert P.run(spark, path).count() == 0
