"""Token-matched samples: a budget for each shard, and the checks of a matched pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamsift.operators.sampling import ranged, running, with_running


def token_count(text: Column) -> Column:
    """A word-and-sign tokenizer that every engine has; pass another column for another tokenizer."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]")).cast("long")


def within_budget(docs: DataFrame, shard: str, key: str, tokens: str, budget: Column, seed: int = 42) -> DataFrame:
    """In seeded order, documents of a shard until exactly ``budget`` tokens: ``docs`` with place, taken (tokens used) and truncated.

    ``docs`` is read twice, so it should be a written table if its tokens are dear. Documents without tokens take no part. The last document gives only what is missing, its text stays whole. A shard with too few tokens gives all; see shortfall.
    """
    own = ranged(docs.where(F.col(tokens) > 0).withColumn("_budget", budget), shard, key, seed)
    # Ranges that begin beyond the budget go before anything is sorted; within a range, sums go on from those of the ranges before it.
    own = with_running(own, running(own, shard, _rows=F.lit(1), _tokens=F.col(tokens)), shard).where("_tokens < _budget")
    order = Window.partitionBy(shard, "_range").orderBy("_order", key)
    upto = F.col("_tokens") + F.sum(tokens).over(order.rowsBetween(Window.unboundedPreceding, 0))
    own = own.withColumns({"place": (F.col("_rows") + F.row_number().over(order)).cast("int"), "_sum": upto})
    before = F.col("_sum") - F.col(tokens)
    taken = F.least(F.col(tokens), F.col("_budget") - before)
    return own.where(before < F.col("_budget")).withColumns({"taken": taken, "truncated": taken < F.col(tokens)}).select(*docs.columns, "place", "taken", "truncated")


def shortfall(matched: DataFrame, shard: str, budgets: DataFrame) -> DataFrame:
    """(shard, budget, taken) of shards whose supply was short; ``budgets`` is (shard, budget)."""
    got = matched.groupBy(shard).agg(F.sum("taken").alias("taken"))
    return budgets.join(got, shard, "left").withColumn("taken", F.coalesce("taken", F.lit(0))).where("taken < budget")


def verify_matched(expected: DataFrame, filtered: DataFrame, unfiltered: DataFrame, shard: str = "shard") -> DataFrame:
    """(shard, problem) by outer joins from the expected shards: a side that is missing, tokens that differ, and bytes other than two for each token.

    ``filtered`` and ``unfiltered`` are (shard, tokens, bytes).
    """
    f = filtered.select(shard, F.col("tokens").alias("ft"), F.col("bytes").alias("fb"))
    u = unfiltered.select(shard, F.col("tokens").alias("ut"), F.col("bytes").alias("ub"))
    own = expected.select(shard).join(f, shard, "left").join(u, shard, "left")
    found = F.array_compact(
        F.array(
            F.when(F.col("ft").isNull(), "filtered: missing"),
            F.when(F.col("ut").isNull(), "unfiltered: missing"),
            F.when(F.col("fb") != 2 * F.col("ft"), "filtered: bytes"),
            F.when(F.col("ub") != 2 * F.col("ut"), "unfiltered: bytes"),
            F.when(F.col("ft") != F.col("ut"), "tokens differ"),
        )
    )
    return own.select(shard, F.explode(found).alias("problem"))


def shard_numbers(spec: str) -> list[int]:
    """Numbers of '0-71,80'."""
    out: list[int] = []
    for part in spec.split(","):
        low, dash, high = part.strip().partition("-")
        out += range(int(low), int(high or low) + 1) if dash else [int(low)]
    return out


def one_file_per_shard(files: DataFrame, shard: str = "shard") -> DataFrame:
    """Shards that don't have exactly one file: (shard, files)."""
    return files.groupBy(shard).agg(F.count("path").alias("files")).where("files <> 1")
