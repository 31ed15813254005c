"""Masks for personal data, as columns of built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamsift.functions import patterns as P
from loamsift.functions.text import occurrences

KINDS = {"emails": (P.EMAIL, P.EMAIL_MASK), "phones": (P.PHONE, P.PHONE_MASK), "ips": (P.IPV4, P.IP_MASK)}


#: What a text must contain for a pattern to match; most texts don't, and skip the costly pattern.
_HINTS = {"emails": lambda t: t.contains("@"), "phones": lambda t: t.rlike(r"(?U)\d{3}"), "ips": lambda t: t.rlike(r"[0-9]\.[0-9]")}


def mask(text: Column, kind: str) -> tuple[Column, Column]:
    """(masked text, how many were masked); a null text is empty.

    No pattern takes part of a mask, so the count is by how many masks there are more than before.
    """
    pattern, mark = KINDS[kind]
    body = F.coalesce(text, F.lit(""))
    masked = F.when(_HINTS[kind](body), F.regexp_replace(body, P.UNICODE + pattern, mark)).otherwise(body)
    return masked, count_masks(masked, mark) - count_masks(body, mark)


def count_masks(text: Column, mark: str) -> Column:
    return occurrences(text, mark)


def mask_all(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` masked by e-mail, phone, then address, each over what the one before left, and counts n_emails, n_phones, n_ips, n_total."""
    for kind in KINDS:
        mark = KINDS[kind][1]
        masked, _ = mask(F.col(text), kind)
        docs = docs.withColumn("_masked", masked)
        docs = docs.withColumn(f"n_{kind}", count_masks(F.col("_masked"), mark) - count_masks(F.coalesce(F.col(text), F.lit("")), mark))
        docs = docs.withColumn(text, F.col("_masked")).drop("_masked")
    return docs.withColumn("n_total", F.col("n_emails") + F.col("n_phones") + F.col("n_ips"))
