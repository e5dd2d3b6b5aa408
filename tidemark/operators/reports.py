"""Reports over scored entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.numbers import fixed_point, observed, percent
from tidemark.operators.ordered import running_totals
from tidemark.operators.quantiles import median
from tidemark.session import cut_lineage


def labelled(cls: Column, yes: str, no: str) -> Column:
    """Text label of a 0/1 class; anything but 1 counts as ``no``."""
    return F.when(cls == 1, yes).otherwise(no)


def status_text(cls: Column, proba: Column) -> Column:
    return F.concat(labelled(cls, fixed.PASS_LABEL, fixed.FAIL_LABEL), F.lit(" ("), percent(proba, 1), F.lit(")"))


def score_rows(scored: DataFrame) -> DataFrame:
    """One row per entity: id, score, score as text, status text."""
    return scored.select(
        "pseudo",
        "note",
        fixed_point(F.col("note"), 2).alias("note_text"),
        status_text(F.col("reussite"), F.col("proba")).alias("status_text"),
    )


def in_order(rows: DataFrame, key: str) -> DataFrame:
    """The rows sorted by an entity's key, each with its ``place`` from 1: places follow from counts per range of keys."""
    totals = running_totals(rows.withColumn("_one", F.lit(1).cast("bigint")), key, ["_one"])
    return totals.select(F.col("_one_upto").alias("place"), *rows.columns).orderBy(key)


def score_report(scored: DataFrame) -> DataFrame:
    """Mean, exact median, population deviation, extremes, success rate, mean probability and count.

    Every entity counts, also one without a note; each figure is over the entities that have it. The three columns are
    written once, so the scoring runs once; everything but the median is one aggregate.
    """
    kept = cut_lineage(scored.select("note", "reussite", "proba"), "scores")
    middle = median(kept, "note")
    note = observed(F.col("note"))
    return kept.agg(
        F.avg(note).alias("mean_note"),
        F.stddev_pop(note).alias("sd_note"),
        F.min(note).alias("min_note"),
        F.max(note).alias("max_note"),
        (F.try_divide(F.sum("reussite"), F.count("reussite")) * 100).alias("success_rate"),
        F.avg("proba").alias("mean_proba"),
        F.count(F.lit(1)).alias("n_entities"),
    ).withColumn("median_note", F.lit(middle).cast("double"))


def summary_table(scored: DataFrame, user: str, moment: Column | None = None) -> DataFrame:
    """Label/value rows of the result summary, in order of ``position``."""
    stats = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("note").alias("mean"),
        F.min("note").alias("least"),
        F.max("note").alias("most"),
        (F.avg("reussite") * 100).alias("rate"),
        F.avg("proba").alias("proba"),
    )
    when = F.date_format(F.current_timestamp() if moment is None else moment, "yyyy-MM-dd HH:mm:ss")
    values = [
        when,
        F.lit(user),
        F.col("n").cast("string"),
        fixed_point(F.col("mean"), 2),
        fixed_point(F.col("least"), 2),
        fixed_point(F.col("most"), 2),
        F.concat(fixed_point(F.col("rate"), 1), F.lit("%")),
        percent(F.col("proba"), 1),
    ]
    lines = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("information"), value.alias("value"))
        for i, (name, value) in enumerate(zip(fixed.SUMMARY_LABELS, values, strict=True), start=1)
    ]
    return stats.select(F.inline(F.array(*lines)))
