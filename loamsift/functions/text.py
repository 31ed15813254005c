"""Text columns: white space, truncation, normalisation, n-grams."""

from __future__ import annotations

import re
import string
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from loamsift.functions import patterns as P


def strip(text: Column) -> Column:
    """Without white space at either end, as Python's str.strip."""
    return F.regexp_replace(text, f"{P.UNICODE}^{P.SPACE}+|{P.SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Line breaks and runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(text, f"{P.UNICODE}{P.SPACE}+", " "))


def words(text: Column) -> Column:
    """White-space separated words; none for a blank text."""
    flat = collapse(text)
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " ", -1))


def truncate_words(text: Column, most: int = 10_000) -> Column:
    """The first ``most`` words, joined by blanks, if there are more; else the text as it is. So many words need twice as many characters, so shorter texts aren't cut up."""
    own = words(text)
    return F.when(F.length(text) < 2 * most, text).when(F.size(own) > most, F.array_join(F.slice(own, 1, most), " ")).otherwise(text)


_PUNCTUATION = str.maketrans("", "", string.punctuation)
_NOT_WORD = re.compile(r"[^\w\s]")


def normalize_text(text: str) -> str:
    """Without combining marks, case, punctuation and superfluous white space."""
    plain = text if text.isascii() else "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    plain = plain.lower().translate(_PUNCTUATION)
    return " ".join((plain if plain.isascii() else _NOT_WORD.sub("", plain)).split())


@F.pandas_udf(StringType())
def _normalized(texts: pd.Series) -> pd.Series:
    return texts.map(normalize_text, na_action="ignore")


def normalize(text: Column) -> Column:
    """normalize_text as a column: Spark has no function for canonical decomposition."""
    return _normalized(text)


@F.pandas_udf(ArrayType(StringType()))
def _normalized_words(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: normalize_text(t).split(), na_action="ignore")


def normalized_words(text: Column) -> Column:
    """Words of the normalised text. They come from Python as an array, so no later expression splits a text again."""
    return _normalized_words(text)


def word_ngrams(own: Column, n: int) -> Column:
    """Distinct n-grams of an array of words; with fewer words one of all of them; without words none."""
    many = F.transform(F.sequence(F.lit(1), F.size(own) - n + 1), lambda i: F.array_join(F.slice(own, i, n), " "))
    one = F.array(F.array_join(own, " "))
    return F.when(F.size(own) == 0, F.array().cast("array<string>")).when(F.size(own) < n, one).otherwise(F.array_distinct(many))


def question_marks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))


def occurrences(text: Column, mark: str) -> Column:
    """How often ``mark`` occurs, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)).cast("long")
