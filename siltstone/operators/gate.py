"""Deterministic gates over the counts of a run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdicts from best to worst.
VERDICTS = ("pass", "caution", "fail")


@dataclass(frozen=True)
class Thresholds:
    """A missing threshold turns its check off; no documents at all always fails."""

    max_removed_absolute: int | None = None
    max_removed_percentage: float | None = None
    max_changed_percentage: float | None = None
    max_item_failure_percentage: float | None = None
    max_empty_or_short_document_percentage: float | None = None


def rank(verdict: Column) -> Column:
    return F.array_position(F.array(*[F.lit(v) for v in VERDICTS]), verdict)


def strictest(verdict: str) -> Column:
    """Aggregate: the worst verdict of a group, pass for none."""
    return F.coalesce(F.max_by(verdict, rank(F.col(verdict))), F.lit("pass"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where the whole is 0."""
    return F.when(whole > 0, part / whole)


def findings(limits: Thresholds) -> Column:
    """The findings of a row with document_count, error_count, skipped_count, empty_or_short_document_count,
    previous_count, removed_count, changed_count, as an array; comparisons are strict."""
    items = F.col("document_count") + F.col("error_count") + F.col("skipped_count")
    tests = [
        ("max_removed_absolute", F.col("removed_count").cast("double")),
        ("max_removed_percentage", ratio(F.col("removed_count"), F.col("previous_count"))),
        ("max_changed_percentage", ratio(F.col("changed_count"), F.col("previous_count"))),
        ("max_item_failure_percentage", ratio(F.col("error_count"), items)),
        ("max_empty_or_short_document_percentage", ratio(F.col("empty_or_short_document_count"), items)),
    ]

    def finding(name, verdict, actual, limit):
        return F.struct(F.lit(name).alias("check"), F.lit(verdict).alias("verdict"), actual.cast("double").alias("actual"), F.lit(limit).cast("double").alias("threshold"))

    found = [F.when(F.col("document_count") == 0, finding("zero_documents", "fail", F.lit(0), 0))]
    for name, actual in tests:
        limit = getattr(limits, name)
        if limit is not None:
            found.append(F.when(actual > limit, finding(name, "caution", actual, limit)))
    return F.filter(F.array(*found), lambda f: f.isNotNull())


def gated(counts: DataFrame, limits: Thresholds) -> DataFrame:
    """counts with their findings and the verdict over them."""
    worst = F.array_max(F.transform("findings", lambda f: rank(f["verdict"])))
    return counts.withColumn("findings", findings(limits)).withColumn("verdict", F.element_at(F.array(*[F.lit(v) for v in VERDICTS]), F.coalesce(worst, F.lit(1)).cast("int")))


def final_verdict(deterministic: str, verifier: str | None) -> str:
    """The stricter of both; without a verifier caution at best."""
    return max(deterministic, verifier or "caution", key=VERDICTS.index)


def batch_summary(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Batches of each verdict, zeros included, and the strictest."""
    return batches.groupBy(*keys).agg(*[F.count_if(F.col("verdict") == v).alias(f"{v}_count") for v in VERDICTS], strictest("verdict").alias("verdict"))


def reason_groups(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Batches that didn't pass, grouped by verdict and reason, by their first batch."""
    return batches.filter("verdict <> 'pass'").groupBy(*keys, "verdict", "reasoning").agg(F.min("batch").alias("first_batch"), F.sort_array(F.collect_list("batch")).alias("batches"))


def pass_groups(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Passed batches with a summary, grouped by it."""
    return batches.filter("verdict = 'pass' and trim(coalesce(reasoning, '')) <> ''").groupBy(*keys, "reasoning").agg(F.min("batch").alias("first_batch"), F.sort_array(F.collect_list("batch")).alias("batches"))
