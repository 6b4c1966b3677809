"""Keep-first and best-of-group operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.urls import preference_score


def first_by_url(items: DataFrame, order: str, url: str = "canonical_url") -> DataFrame:
    """The first item of each address; items without one (anomalies among them) all stay."""
    rank = Window.partitionBy(url).orderBy(order)
    named = items.filter(F.col(url).isNotNull()).withColumn("rank", F.row_number().over(rank)).filter("rank = 1").drop("rank")
    return named.unionByName(items.filter(F.col(url).isNull()))


def preference(url: Column, substrings: list[str]) -> Column:
    """What the preferred copy has least of: more preferred substrings, then the shorter address, then the smaller."""
    return F.struct((-preference_score(url, substrings)).alias("score"), F.length(url).alias("length"), url.alias("url"))


def best_of(documents: DataFrame, key: str, prefer: list[str] | None = None, url: str = "canonical_url", keep_null: bool = True) -> DataFrame:
    """The preferred document of each key; documents without one all stay (keep_null) or are left out.

    The pre-shuffle limit of the rank filter sends at most one row of a key per partition, so a key that holds a third
    of all rows doesn't land in one task.
    """
    rank = Window.partitionBy(key).orderBy(preference(F.col(url), prefer or []))
    kept = documents.filter(F.col(key).isNotNull()).withColumn("rank", F.row_number().over(rank)).filter("rank = 1").drop("rank")
    return kept.unionByName(documents.filter(F.col(key).isNull())) if keep_null else kept


def deduped(documents: DataFrame, by_content: bool = False, prefer: list[str] | None = None) -> DataFrame:
    """By external id always, by content if asked, in this order."""
    one = best_of(documents, "external_id", prefer)
    return best_of(one, "normalized_content_hash", prefer) if by_content else one
