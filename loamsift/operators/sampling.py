"""Samples that are the same at every run: rows are ordered by the SHA-1 of a seed and their key, which SQL engines agree on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(key: Column, seed: int) -> Column:
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows; each task keeps its own best n, so only those are sorted together."""
    return rows.orderBy(order_key(F.col(key), seed), key).limit(n)


def balanced(rows: DataFrame, label: str, key: str, per_label: int = 500, seed: int = 42) -> DataFrame:
    """At most ``per_label`` rows of each label, with ``rank``; Spark limits each task's rows of a label before the shuffle."""
    best = Window.partitionBy(label).orderBy(order_key(F.col(key), seed), key)
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_label)


#: Hexadecimal digits of an order key that deal a shard's rows into ranges: 16 to this power for each shard.
RANGE_DIGITS = 3


def ranged(rows: DataFrame, shard: str, key: str, seed: int) -> DataFrame:
    """``rows`` with _order, their place in a seeded order of their shard, and _range, its leading digits: ranges of a shard follow each other, and each holds an even part of it."""
    order = order_key(F.concat_ws("|", F.col(shard), F.col(key).cast("string")), seed)
    return rows.withColumn("_order", order).withColumn("_range", F.substring("_order", 1, RANGE_DIGITS))


def running(own: DataFrame, shard: str, **sums: Column) -> DataFrame:
    """(shard, _range, *sums): for each range the sums over the ranges of its shard before it; at most 16^RANGE_DIGITS rows for each shard."""
    each = own.groupBy(shard, "_range").agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    before = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(F.col(shard).alias("_shard"), F.col("_range").alias("_r"), *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(k) for k in sums])


def with_running(own: DataFrame, before: DataFrame, shard: str) -> DataFrame:
    """``own`` joined to what ``running`` gave, null shards included."""
    return own.join(before, F.col(shard).eqNullSafe(F.col("_shard")) & (F.col("_range") == F.col("_r"))).drop("_shard", "_r")


def permuted(rows: DataFrame, shard: str, key: str, seed: int = 42) -> DataFrame:
    """``rows`` with their place (from 1) in a seeded permutation of their shard.

    Places within a range are counted by themselves and moved on by the rows of the ranges before it, so no task sorts a whole shard.
    """
    own = ranged(rows, shard, key, seed)
    own = with_running(own, running(own, shard, _before=F.lit(1)), shard)
    best = Window.partitionBy(shard, "_range").orderBy("_order", key)
    return own.withColumn("place", (F.row_number().over(best) + F.col("_before")).cast("int")).select(*rows.columns, "place")


def first_rows(rows: DataFrame, file: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each file, which a plain limit wouldn't give."""
    best = Window.partitionBy(file).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= n).drop("_n")


def strided(files: DataFrame, path: str, ranks: int) -> DataFrame:
    """``files`` with the rank that reads each: in order of their paths, every ``ranks``-th from the rank's own number on. Ranks are disjoint and differ by one file at most."""
    if ranks < 1:
        raise ValueError("ranks must be at least 1")
    order = Window.partitionBy(F.lit(0)).orderBy(path)  # a row for each file, not for each of its rows
    return files.select(path).distinct().withColumn("rank", F.pmod(F.row_number().over(order) - 1, F.lit(ranks)))
