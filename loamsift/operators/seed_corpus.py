"""Texts for training the quality classifier: positives from pages that good sites link to, negatives from any crawl."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamsift.functions.text import collapse

# Limits of the positives.
MAX_RAW_BYTES = 5 * 1024 * 1024
MAX_TEXT_CHARS = 500_000
LANGUAGE_SCORE = 0.5
CONTENT_SCORE = 0.7
NEGATIVES = 10_000


def positive_decisions(pages: DataFrame, raw_bytes: Column, text: Column, language: Column, nsfw: Column, toxic: Column) -> DataFrame:
    """``pages`` with text (one line) and removed_by: too_large, language, nsfw, toxic or empty, whichever comes first; null for positives.

    language, nsfw and toxic are struct(label, score). Content counts only from a score of 0.7 on. The Gopher rules take no part: the
    surveyed script's test of them is never true.
    """
    by = (
        F.when((raw_bytes > MAX_RAW_BYTES) | (F.length(text) > MAX_TEXT_CHARS), "too_large")
        .when(~F.coalesce((language["label"] == "en") & (language["score"] >= LANGUAGE_SCORE), F.lit(False)), "language")
        .when((nsfw["label"] == "nsfw") & (nsfw["score"] >= CONTENT_SCORE), "nsfw")
        .when((toxic["label"] == "toxic") & (toxic["score"] >= CONTENT_SCORE), "toxic")
        .when(F.coalesce(collapse(text), F.lit("")) == "", "empty")
    )
    return pages.withColumns({"removed_by": by, "text": collapse(text)})


def negatives(rows: DataFrame, order: str, text: str = "text", number: int = NEGATIVES) -> DataFrame:
    """(value): training lines of the first ``number`` rows, in order, that aren't blank, in any language. Each task keeps its own first rows, so only those are sorted together."""
    own = rows.where(F.coalesce(collapse(F.col(text)), F.lit("")) != "").orderBy(order).limit(number)
    return own.select(F.concat(F.lit("__label__negative "), F.translate(F.col(text), "\n\r", "  ")).alias("value"))


def english_of_any_score(rows: DataFrame, language: str) -> DataFrame:
    """Rows whose language, a struct(label, score), is English, however sure."""
    return rows.where(F.col(language)["label"] == "en")


def training_set(positives: DataFrame, negatives_: DataFrame) -> DataFrame:
    """All rows of both, columns that one lacks as nulls."""
    return positives.unionByName(negatives_, allowMissingColumns=True)
