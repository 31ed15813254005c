"""Connected components by alternating large-star and small-star steps, in a logarithmic number of rounds; few edges are settled at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamsift.session import materialize, release

MAX_ROUNDS = 60
#: Up to so many edges (16 bytes each) one task settles what is left, whatever the degrees; beyond, rounds of stars do.
FEW_EDGES = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(low.select("u", F.col("m").alias("v")))


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes in order, the smallest node that each reaches): roots hook onto smaller roots, then every node jumps to its root."""
    node, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(node))
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return node, node[root]
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up


def _at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if parts:
        node, low = smallest_reachable(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(low)], names=["node", "component"])


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of ``edges`` (u, v), which should be a written table.

    Each round is written to the shared scratch folder, so a lost executor costs no more than a round. Joins are on nodes,
    whose degrees Spark splits if they are skewed; minima are combined before they are shuffled. Rounds go on until the stars settle or at most
    ``few`` edges are left.
    """
    own = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    mark, last = None, None
    for _ in range(MAX_ROUNDS):
        number, total = own.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if number <= few:
            return own.coalesce(1).mapInArrow(_at_once, "node long, component long")
        if (number, total) == mark:
            stars = own.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.unionByName(own.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = (number, total)
        own = materialize(_small_star(_large_star(own)).where("u <> v").distinct())
        if last is not None:
            release(last)
        last = own
    raise RuntimeError("components did not settle")
