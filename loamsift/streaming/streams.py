"""The per-document stages over streams: they keep no state, so the batch functions serve as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamsift.functions.gopher import gopher
from loamsift.functions.pii import mask_all


def curate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents that pass the Gopher rules, personal data masked; for batches and streams."""
    return mask_all(gopher(docs, text).where("passed").select(*docs.columns), text)


def first_seen(docs: DataFrame, time: str, delay: str = "1 hour", text: str = "text") -> DataFrame:
    """The first of equal texts within a watermark, in bounded state."""
    keyed = docs.withColumn("_hash", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    if docs.isStreaming:
        return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_hash"]).drop("_hash")
    return keyed.dropDuplicates(["_hash"]).drop("_hash")


def rejections(docs: DataFrame, time: str, window: str = "10 minutes", delay: str = "1 hour", text: str = "text", judge_empty: bool = False) -> DataFrame:
    """(start, check, count) of failed rules in windows of event time."""
    failed = gopher(docs, text, judge_empty).select(time, F.explode("failed_checks").alias("check"))
    own = failed.withWatermark(time, delay) if docs.isStreaming else failed
    return own.groupBy(F.window(time, window).alias("w"), "check").agg(F.count("*").alias("count")).select(F.col("w.start").alias("start"), "check", "count")
