"""The curation pipeline: HTML, language, Gopher rules, quality, content, then masks; one row for each document with what became of it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamsift.functions import html, pii
from loamsift.functions.gopher import gopher
from loamsift.operators import classify
from loamsift.operators.near_dup import Settings, drop_near_duplicates
from loamsift.operators.reports import funnel

STAGES = ["missing_text", "empty_text", "language", "gopher", "quality", "nsfw", "toxic"]


@dataclass
class Plan:
    """Which stages run. A model that is None switches its stage off. ``drop_empty=False`` keeps texts that are empty (after extraction) past all stages;
    ``judge_empty=True`` sends empty and null ones through the stages as any other."""

    extract_html: bool = True
    language: classify.Model | None = None
    language_column: str | None = None
    gopher: bool = True
    quality: classify.Model | None = None
    nsfw: classify.Model | None = None
    toxic: classify.Model | None = None
    mask_pii: bool = True
    drop_empty: bool = True
    judge_empty: bool = False
    near_duplicates: Settings | None = None
    extra: dict = field(default_factory=dict)


def decisions(docs: DataFrame, plan: Plan, text: str = "text") -> DataFrame:
    """``docs`` with html_type, stage columns and removed_by (null: kept), text as extracted.

    Models see only rows that the stages before them let through: the rest is sent as null, which costs them nothing.
    """
    spark = docs.sparkSession
    own = docs.withColumn("html_type", F.when(F.col(text).isNull(), "none").otherwise(html.html_type(F.col(text))))
    if plan.extract_html:
        tagged = F.when(~F.col("html_type").isin("none", "empty", "plain_text"), F.col(text))
        own = own.withColumn("_extracted", html.extract(tagged)).withColumn(text, F.coalesce("_extracted", text)).drop("_extracted")
    body = F.col(text)
    removed, judged, judge = F.when(body.isNull(), "missing_text"), body != "", plan.judge_empty
    if judge:
        removed, judged = F.lit(None).cast("string"), F.lit(True)
    elif plan.drop_empty:
        removed = removed.when(body == "", "empty_text")
    own = own.withColumn("removed_by", removed)
    alive = F.when(F.col("removed_by").isNull() & judged, body)

    def settle(frame: DataFrame, stage: str, keep: Column) -> DataFrame:
        return frame.withColumn("removed_by", F.coalesce("removed_by", F.when(judged & ~F.coalesce(keep, F.lit(False)), stage)))

    if plan.language_column:
        own = own.withColumns({"detected_language": F.col(plan.language_column), "language_score": F.lit(1.0)})
        own = settle(own, "language", F.col("detected_language") == "en")
    elif plan.language:
        own = own.withColumn("_l", classify.identify_language(spark, plan.language, alive, judge_empty=judge))
        own = own.withColumns({"detected_language": F.col("_l.label"), "language_score": F.col("_l.score")})
        own = settle(own, "language", classify.is_english(F.col("_l"))).drop("_l")
    if plan.gopher:
        made = gopher(own, text, judge)
        own = settle(made, "gopher", F.col("passed")).select(*own.columns, "failed_checks")
    for stage, model in (("quality", plan.quality), ("nsfw", plan.nsfw), ("toxic", plan.toxic)):
        if model is None:
            continue
        found = classify.classify_quality(spark, model, alive, judge) if stage == "quality" else classify.classify_content(spark, model, alive, stage, judge_empty=judge)
        own = own.withColumn("_f", found).withColumns({f"{stage}_label": F.col("_f.label"), f"{stage}_score": F.col("_f.score")})
        good = F.col("_f.label") == "positive" if stage == "quality" else F.col("_f.label") != stage
        own = settle(own, stage, good).drop("_f")
    return own


def curated(docs: DataFrame, plan: Plan, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Kept documents, masked last, near duplicates of what is kept left out if asked."""
    kept = decisions(docs, plan, text).where(F.col("removed_by").isNull()).drop("removed_by", "failed_checks")
    if plan.mask_pii:
        kept = pii.mask_all(kept, text).drop("n_emails", "n_phones", "n_ips", "n_total")
    return drop_near_duplicates(kept, plan.near_duplicates, key, text) if plan.near_duplicates else kept


def report(decided: DataFrame) -> DataFrame:
    """The funnel of the stages; near duplicates are counted by near_dup.NearDuplicates.counts."""
    return funnel(decided, STAGES)
