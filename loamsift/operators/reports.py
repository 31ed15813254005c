"""Reports over decision tables, samples and curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def histogram(rows: DataFrame, column: str, count: str = "count", pct: str = "pct") -> DataFrame:
    """(column, count, pct of all rows)."""
    own = rows.groupBy(column).agg(F.count("*").alias(count))
    return own.withColumn(pct, 100.0 * F.col(count) / F.sum(count).over(Window.partitionBy(F.lit(0))))


def top_with_others(counts: DataFrame, column: str, k: int, count: str = "count", others: str = "others") -> DataFrame:
    """The ``k`` largest classes, ties by name, and one row for the rest."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(count), column)
    named = counts.withColumn("_rank", F.row_number().over(order)).withColumn(column, F.when(F.col("_rank") <= k, F.col(column)).otherwise(others))
    return named.groupBy(column).agg(F.sum(count).alias(count))


def top_per_group(counts: DataFrame, group: str, column: str, k: int, count: str = "count") -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.desc(count), column)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def funnel(decisions: DataFrame, stages: list[str]) -> DataFrame:
    """(position, stage, docs_in, removed, pct): removals belong to the first stage that failed; ``removed_by`` is null for kept rows.

    One pass: a conditional count for each stage; the running difference is over as many rows as there are stages.
    """
    one = decisions.agg(F.count("*").alias("n"), *[F.count_if(F.col("removed_by") == s).alias(f"_{i}") for i, s in enumerate(stages)])
    rows, seen = [], F.lit(0).cast("long")
    for i, s in enumerate(stages):
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage"), (F.col("n") - seen).alias("docs_in"), F.col(f"_{i}").alias("removed")))
        seen = seen + F.col(f"_{i}")
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("pct", F.when(F.col("docs_in") > 0, 100.0 * F.col("removed") / F.col("docs_in")).otherwise(0.0))


def latency(samples: DataFrame, group: str, value: str) -> DataFrame:
    """count, mean, p50, p95, p99 (exact, by linear interpolation) and max of each group."""
    p = {f"p{q}": F.percentile(value, F.lit(q / 100)) for q in (50, 95, 99)}
    return samples.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), *[v.alias(k) for k, v in p.items()], F.max(value).alias("max"))


def throughput(totals: DataFrame, seconds: float) -> DataFrame:
    """``totals`` (rows, kept, chars) with rows_per_second, kept_pct and mb_per_second."""
    return totals.withColumns({"rows_per_second": F.col("rows") / F.lit(seconds), "kept_pct": 100.0 * F.col("kept") / F.col("rows"), "mb_per_second": F.col("chars") / 1e6 / F.lit(seconds)})


def accuracy(scored: DataFrame, label: str, predicted: str) -> DataFrame:
    """(label, n, accuracy) of each label and, with a null label, of all."""
    hit = F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy")
    return scored.groupingSets([[F.col(label)], []], label).agg(F.count("*").alias("n"), hit)


def against_baseline(runs: DataFrame, name: str, value: str, base: str) -> DataFrame:
    """``runs`` with speedup (base over value) and change_pct against the row named ``base``."""
    b = runs.where(F.col(name) == base).select(F.first(value).alias("_base"))
    joined = runs.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one")
    return joined.withColumns({"speedup": F.col("_base") / F.col(value), "change_pct": 100.0 * (F.col(value) - F.col("_base")) / F.col("_base")}).drop("_one", "_base")


def crossing(curve: DataFrame, x: str, y: str, level: float, group: str | None = None) -> DataFrame:
    """Where an ordered curve first falls to ``level``, by linear interpolation between neighbours: (group,) crossing."""
    order = Window.partitionBy(group or F.lit(0)).orderBy(x)
    own = curve.withColumns({"_x": F.lag(x).over(order), "_y": F.lag(y).over(order)})
    at = own.where((F.col("_y") >= level) & (F.col(y) <= level) & (F.col("_y") > F.col(y)))
    place = F.col("_x") + (F.col("_y") - level) / (F.col("_y") - F.col(y)) * (F.col(x) - F.col("_x"))
    return at.groupBy(*([group] if group else [])).agg(F.min(place).alias("crossing"))


def bits_per_byte(rows: DataFrame, nll: str, n_bytes: str) -> DataFrame:
    """Total negative log-likelihood (nats) in bits for each byte of text."""
    return rows.agg((F.sum(nll) / (F.sum(n_bytes) * F.log(F.lit(2.0)))).alias("bits_per_byte"))


def http_status(codes: DataFrame, status: str = "status") -> DataFrame:
    """(status, count, success), success being 200 to 399."""
    return codes.groupBy(status).agg(F.count("*").alias("count")).withColumn("success", F.col(status).between(200, 399))


def dataset_totals(manifest: DataFrame, budget: int) -> DataFrame:
    """One row over complete shards of a manifest (filtered_tokens, unfiltered_tokens, filtered_docs, unfiltered_docs, sampled_pct, config): sums, the mean percentage sampled,
    the part of a token budget, and how many shards each configuration made, as 'config: n' in order."""
    config = manifest.groupBy("config").agg(F.count("*").alias("n")).select(F.concat_ws(": ", "config", F.col("n").cast("string")).alias("c"))
    listed = config.agg(F.array_join(F.array_sort(F.collect_list("c")), "; ").alias("filter_configs"), F.lit(1).alias("_one"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("filtered_tokens", "unfiltered_tokens", "filtered_docs", "unfiltered_docs")]
    own = manifest.agg(F.count("*").alias("shards"), *sums, F.coalesce(F.avg("sampled_pct"), F.lit(0.0)).alias("mean_sampled_pct"), F.lit(1).alias("_one"))
    return own.join(listed, "_one").drop("_one").withColumn("pct_of_budget", 100.0 * F.col("filtered_tokens") / F.lit(budget))


def compare_arms(scores: DataFrame, prompt: str, arm: str, value: str, first: str, second: str) -> DataFrame:
    """One row: prompts that both arms answered, on how many ``first`` is lower than ``second``, and each arm's number, median and mean over its own answers. Nulls are no answers."""
    both = [F.max(F.when(F.col(arm) == a, F.col(value))).alias(c) for a, c in ((first, "_a"), (second, "_b"))]
    own = scores.where(F.col(value).isNotNull()).groupBy(prompt).agg(*both)
    kept = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    of = [x for c, n in (("_a", "first"), ("_b", "second")) for x in (F.count(c).alias(f"{n}_n"), F.percentile(c, F.lit(0.5)).alias(f"{n}_median"), F.avg(c).alias(f"{n}_mean"))]
    return own.agg(F.count_if(kept).alias("prompts"), F.count_if(kept & (F.col("_a") < F.col("_b"))).alias("first_lower"), *of)


def label_counts(scored: DataFrame, *labels: str) -> DataFrame:
    """(label_column, label, count) of several label columns, in one pass."""
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("label_column"), F.col(c).cast("string").alias("label")) for c in labels]))
    return scored.select(rows.alias("r")).select("r.*").groupBy("label_column", "label").agg(F.count("*").alias("count"))
