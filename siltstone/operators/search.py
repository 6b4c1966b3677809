"""Exact cosine search over the content of live runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.vectors import cosine, literal

DEFAULT_LIMIT = 10


class IncompatibleRun(ValueError):
    """The run was embedded in another space than the query would be."""


def require_compatible(run: dict, dimensions: int, fingerprint: str) -> None:
    """Raises before a query is embedded if the run's space differs."""
    if run.get("embedding_dimensions") != dimensions or run.get("embedding_fingerprint") != fingerprint:
        raise IncompatibleRun(f"run {run.get('id')} has another embedding space")


def live_chunks(chunks: DataFrame, indexes: DataFrame, documents: DataFrame) -> DataFrame:
    """The live view: chunks of each index's live run with their documents' fields. The pointer table is small, so it
    is broadcast by its size and prunes run partitions."""
    pointers = indexes.filter("live_run_id is not null").select(F.col("name").alias("index_name"), F.col("live_run_id").alias("run_id")).distinct()
    fields = documents.select(F.col("id").alias("document_id"), "run_id", "canonical_url", "title", "locale").dropDuplicates(["document_id", "run_id"])
    return chunks.distinct().join(pointers, "run_id").join(fields, ["document_id", "run_id"])


def scored(chunks: DataFrame, query: list[float]) -> DataFrame:
    """Chunks with a usable vector, with score and distance (1 - score)."""
    score = cosine(F.col("embedding"), literal(query))
    return chunks.withColumn("score", score).filter("score is not null and not isnan(score)").withColumn("distance", 1 - F.col("score"))


def top_k(chunks: DataFrame, query: list[float], k: int = DEFAULT_LIMIT, tie: str = "chunk_id") -> DataFrame:
    return scored(chunks, query).orderBy("distance", tie).limit(k)


def top_k_per_index(chunks: DataFrame, query: list[float], k: int = DEFAULT_LIMIT, index: str = "index_name", tie: str = "chunk_id") -> DataFrame:
    """The k best of each index; the rank filter keeps k rows per partition before the shuffle."""
    rank = Window.partitionBy(index).orderBy("distance", tie)
    return scored(chunks, query).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)


def merged(per_index: DataFrame, k: int = DEFAULT_LIMIT, tie: str = "chunk_id") -> DataFrame:
    return per_index.orderBy(F.desc("score"), tie).limit(k)
