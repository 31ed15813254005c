"""License scans by diagonal voting.

The rolling k-gram hashes of all words of all documents are joined to the positions of those grams in the templates. Matches
are counted by (document, template, diagonal), a diagonal being the place in the document less that in the template; neighbouring diagonals,
which insertions and deletions cause, are merged; and the spans they give are verified word by word.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamsift.llm import _common as C

PHRASE_K, NOTICE_K = 2, 4
DIAGONAL_GAP = 4
MIN_VOTES = 2
MIN_COVERAGE = 0.6
#: Documents with candidates, up to which their ids are broadcast; beyond, the join shuffles both sides.
BROADCAST_ROWS = 200_000

# Phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of public licence notices, with labels of this module's own.
NOTICES = {
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "apache-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-statement": "this work is licensed under the gnu general public license version 3",
    "lgpl-notice": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc-notice": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "boost-notice": "distributed under the boost software license version 1 0",
    "cc-by-statement": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-statement": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "mit-statement": "released under the mit license",
    "apache-statement": "licensed under the apache license version 2 0",
}


@dataclass(frozen=True)
class Template:
    words: tuple[str, ...]
    label: str
    base: bool

    @property
    def k(self) -> int:
        return PHRASE_K if self.base else NOTICE_K


def templates() -> list[Template]:
    return [Template(tuple(p.split()), label, True) for p, label in BASE_PHRASES.items()] + [Template(tuple(t.split()), label, False) for label, t in NOTICES.items()]


def _bytes(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    return raw, np.array([0, len(raw)])


def template_positions(known: list[Template]) -> list[tuple[int, int, int, int]]:
    """(k, gram, template, place) of each gram of each template."""
    out = []
    for t, tpl in enumerate(known):
        g = C.grams(C.Words(*_bytes(" ".join(tpl.words))).hash, tpl.k).view(np.int64)
        out += [(tpl.k, int(h), t, i) for i, h in enumerate(g)]
    return out


def document_grams(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, and the rolling k-gram hashes of all words, for either k; the place in an array is the word's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=1 << 20):
            w = C.Words(*C.string_bytes(batch.column("text")))
            n = np.diff(w.first)
            lists = []
            for k in (PHRASE_K, NOTICE_K):
                g, ok = C.grams(w.hash, k).view(np.int64), C.within(w.first, k, len(w))
                lists.append(C.int_lists(g[ok], np.maximum(n - k + 1, 0)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *lists], names=["doc_id", "text_key", "g_phrase", "g_notice"])

    return docs.mapInArrow(run, "doc_id long, text_key long, g_phrase array<long>, g_notice array<long>")


def diagonals(grams: DataFrame, known: list[Template]) -> DataFrame:
    """Votes by (doc_id, text_key, template, diagonal), neighbouring diagonals of notices merged: (start, stop) in words of the document."""
    spark = grams.sparkSession
    places = spark.createDataFrame(template_positions(known), "k int, gram long, template int, place int")
    # One pass: phrase grams come first, then notice grams, whose places start anew.
    rolled = grams.select("doc_id", "text_key", F.size("g_phrase").alias("n"), F.posexplode(F.concat("g_phrase", "g_notice")).alias("at", "gram"))
    rolled = rolled.select("doc_id", "text_key", "gram", F.when(F.col("at") < F.col("n"), F.col("at")).otherwise(F.col("at") - F.col("n")).alias("at"))
    # The join's other side is fixed: the grams of the templates above.
    found = rolled.join(F.broadcast(places.drop("k")), "gram").withColumn("diagonal", F.col("at") - F.col("place"))
    votes = found.groupBy("doc_id", "text_key", "template", "diagonal").agg(F.count("*").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high"))
    full = {t: len(x.words) - PHRASE_K + 1 for t, x in enumerate(known) if x.base}
    phrase = F.col("template").isin(list(full))
    need = F.create_map(*[F.lit(x) for kv in full.items() for x in kv])
    phrases = votes.where(phrase & (F.col("votes") >= need[F.col("template")])).select("doc_id", "text_key", "template", F.col("diagonal").alias("start"), F.col("diagonal").alias("stop"))
    near = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    fresh = F.when(F.col("diagonal") - F.lag("diagonal").over(near) <= DIAGONAL_GAP, 0).otherwise(1)
    notices = votes.where(~phrase).withColumn("run", fresh).withColumn("run", F.sum("run").over(near))
    merged = notices.groupBy("doc_id", "text_key", "template", "run").agg(F.sum("votes").alias("votes"), F.min("low").alias("start"), (F.max("high") + NOTICE_K).alias("stop"))
    return phrases.unionByName(merged.where(F.col("votes") >= MIN_VOTES).select("doc_id", "text_key", "template", "start", "stop"))


def verify(words: C.Words, base: int, size: int, tpl: Template, start: int, stop: int) -> tuple[float, int, int]:
    """(the part of the template's words found in order in the span, the first word found, the word after the last). The span is widened by what a template may lack on either side.

    A long span, which repetitive texts give, is compared piece by piece; pieces overlap by half, three templates' lengths, so a notice lies whole in one of them.
    """
    if tpl.base:
        got = [words.text(base + i).decode("utf-8", "replace") for i in range(max(start, 0), min(start + len(tpl.words), size))]
        return float(start >= 0 and got == list(tpl.words)), start, start + len(tpl.words)
    room = len(tpl.words)
    low, high = max(0, start - room), min(size, max(stop, start) + room)
    best = (0.0, start, stop)
    for at in range(low, max(low + 1, high - 3 * room), 3 * room):
        piece = [words.text(base + i).decode("utf-8", "replace") for i in range(at, min(high, at + 6 * room))]
        match = difflib.SequenceMatcher(None, list(tpl.words), piece, autojunk=False)
        blocks = [b for b in match.get_matching_blocks() if b.size >= 2]
        coverage = sum(b.size for b in blocks) / room
        if coverage > best[0]:
            best = (coverage, at + blocks[0].b, at + blocks[-1].b + blocks[-1].size)
    return best


def scan(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """Per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (label, start, stop, coverage).

    Words are runs of letters, digits and non-ASCII characters with A-Z lowered. Null and empty texts have no words, no labels and score 0. Repeated rows
    each get their row. score is the best coverage of a template among verified and rejected candidates, 1 for a base phrase.
    """
    known = known or templates()
    own = C.keyed_rows(docs).withColumn("text_key", F.xxhash64("text"))
    spans = diagonals(document_grams(own), known)
    by_doc = C.materialize(spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("template", "start", "stop"))).alias("candidates")))
    small = C.is_small(by_doc, BROADCAST_ROWS)
    keyed = by_doc.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "candidates")
    joined = own.join(F.broadcast(keyed) if small else keyed, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left").select("doc_id", "text", "candidates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches, limit=1 << 20):
            w = C.Words(*C.string_bytes(batch.column("text")))
            out = []
            for r, (doc, got) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("candidates").to_pylist(), strict=True)):
                base, size = int(w.first[r]), int(w.first[r + 1] - w.first[r])
                places, base_labels, labels, score, kept = set(), set(), set(), 0.0, []
                for c in got or ():
                    tpl = known[c["template"]]
                    coverage, start, stop = verify(w, base, size, tpl, c["start"], c["stop"])
                    score = max(score, coverage)
                    if tpl.base and coverage == 1:
                        places.add((c["start"], tpl.label, len(tpl.words)))
                    elif not tpl.base and coverage >= MIN_COVERAGE:
                        labels.add(tpl.label)
                        kept.append({"label": tpl.label, "start": start, "stop": stop, "coverage": coverage})
                base_labels = {p[1] for p in places}
                kept += [{"label": p[1], "start": p[0], "stop": p[0] + p[2], "coverage": 1.0} for p in sorted(places)]
                starts = [p[0] for p in places]
                out.append((doc, size, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), min(score, 1.0), kept))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("coverage", pa.float64())])
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
    return joined.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, start: long, stop: long, coverage: double>>")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(C.table(spark, sf_dir, "documents")).drop("spans")
