"""Exact line dedup: lines that occur more than once anywhere go, all copies of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos, line, hash): a null text has no lines, an empty one has one empty line. Split at \\n only."""
    cut = docs.select(key, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    return cut.withColumn("hash", F.unhex(F.sha2("line", 256)))


def frequencies(own: DataFrame) -> DataFrame:
    """(hash, count): combined before the shuffle, so a common line costs a row for each task."""
    return own.groupBy("hash").agg(F.count("*").alias("count"))


def stats(counts: DataFrame) -> DataFrame:
    """One row: total lines, unique lines (count 1), distinct duplicated lines, occurrences removed."""
    many = F.col("count") > 1
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_lines"),
        F.count_if(F.col("count") == 1).alias("unique_lines"),
        F.count_if(many).alias("duplicate_lines"),
        F.coalesce(F.sum(F.when(many, F.col("count")).otherwise(0)), F.lit(0)).alias("removed_occurrences"),
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "none") -> DataFrame:
    """(key, text, n_lines, n_kept) with repeated lines taken out; a document left without lines has an empty text.

    keep="none" removes all copies; keep="first" leaves that of the smallest (key, position).
    """
    own = lines(docs, key, text)
    if keep == "none":
        left = own.join(frequencies(own).where("count = 1").select("hash"), "hash", "left_semi")
    elif keep == "first":
        first = own.groupBy("hash").agg(F.min(F.struct(key, "pos")).alias("f")).select("hash", F.col(f"f.{key}").alias(key), "f.pos")
        left = own.join(first, ["hash", key, "pos"], "left_semi")
    else:
        raise ValueError("keep is 'none' or 'first'")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n")
    kept = left.groupBy(key).agg(joined.alias("_text"), F.count("*").alias("_n"))
    base = docs.select(key, F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long").alias("n_lines"))
    return base.join(kept, key, "left").select(key, F.coalesce("_text", F.lit("")).alias("text"), "n_lines", F.coalesce("_n", F.lit(0)).alias("n_kept"))
