"""From raw documents to packed training sequences, in five stages; each is written as Parquet and reread by the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loamsift.llm import _common, decontaminate, ngram_join, packing, quality_nbsvm, suffix_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, doesn't reject.

    A null or empty text has the score of the model's bias, so all such rows stay or all go; repeated rows get the same answer. Without labelled documents all rows stay, with
    labels of one class all or none. An empty table gives an empty table.
    """
    labels = _common.table(spark, sf_dir, "labels")
    model = quality_nbsvm.train(quality_nbsvm.training_rows(docs, labels))
    return quality_nbsvm.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that word 5-grams link at a Jaccard similarity of 0.75, that of the smallest doc_id.

    Null and blank texts have no n-grams, link nothing and stay; so do rows without doc_id. Rows that repeat doc_id and text are one document and stay or go together;
    rows that share only the doc_id are judged each by its text.
    """
    return ngram_join.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages: maximal runs of bytes, covered by strings of 240 that also start elsewhere, of 400 bytes or of over 50 words; n_chars follows.

    All copies of a passage go. A null text stays null; a text that is removed as a whole is empty, and its row stays. Repeated rows lose what they repeat.
    """
    return suffix_dedup.deduplicate(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no 10-word window of a benchmark item (of a shorter item, all its words).

    Null and empty texts hold none and stay. Null, empty and repeated items, and items without id, are allowed; without items all rows stay.
    """
    return decontaminate.decontaminate(docs, _common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents and their places in sequences of 2048 tokens.

    A null or empty text is the end token alone. A long text is cut; repeated rows and rows without doc_id are documents of their own.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_free", benchmark_free),
    ("packed", packed),
]

#: SQL can't express the classifier or the tokenizer; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        done = _common.materialize(stage(spark, docs, sf_dir))
        _common.release(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
