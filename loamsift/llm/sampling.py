"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded_by_class(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each class, the same at every run: those of the smallest hashes.

    Classes are counted first (combined before the shuffle), and a class's rows beyond twice its share are left out where they are read, so that no
    class, however common, is sorted as a whole.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    order = F.xxhash64(F.lit(7), "doc_id", "text")
    unit = F.pmod(order, F.lit(1 << 20)) / float(1 << 20)
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(label) == F.lit(value)) & (unit < min(1.0, 2.0 * per_class / n)))
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_order", "doc_id"))
    return rows.where(keep).withColumn("_order", order).withColumn("_rank", rank).where(F.col("_rank") <= per_class).drop("_rank", "_order")
