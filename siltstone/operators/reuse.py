"""Vectors reused by content hash, so that only new content goes to a provider."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USABLE_STATES = ("complete", "activated", "superseded")


def candidate_runs(runs: DataFrame, index_name: str | None = None, dimensions: int | None = None, fingerprint: str | None = None, newest: int = 5) -> DataFrame:
    """The newest usable runs of each index in the same embedding space (fingerprint from the metadata)."""
    found = runs.withColumn("embedding_fingerprint", F.get_json_object("metadata", "$.embedding_fingerprint")).filter(F.col("lifecycle_status").isin(*USABLE_STATES))
    if index_name is not None:
        found = found.filter(F.col("index_name") == index_name)
    if dimensions is not None:
        found = found.filter(F.col("embedding_dimensions") == dimensions)
    if fingerprint is not None:
        found = found.filter(F.col("embedding_fingerprint") == fingerprint)
    once = found.select("id", "index_name", "embedding_dimensions", "embedding_fingerprint", "started_at").distinct()
    rank = Window.partitionBy("index_name", "embedding_dimensions", "embedding_fingerprint").orderBy(F.desc("started_at"), F.desc("id"))
    return once.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= newest).drop("rank")


def reusable_vectors(chunks: DataFrame, runs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(index_name, content_hash, embedding, run_id): the newest run's vector of each hash. `wanted` (content_hash)
    narrows by a semi-join before the shuffle."""
    found = chunks.filter("embedding is not null and content_hash is not null")
    if wanted is not None:
        found = found.join(wanted.select("content_hash").distinct(), "content_hash", "left_semi")
    joined = found.join(runs.select(F.col("id").alias("run_id"), "index_name", "started_at"), "run_id")
    rank = Window.partitionBy("index_name", "content_hash").orderBy(F.desc("started_at"), F.desc("run_id"), "chunk_id")
    return joined.withColumn("rank", F.row_number().over(rank)).filter("rank = 1").select("index_name", "content_hash", "embedding", "run_id")


def missing_hashes(chunks: DataFrame, reusable: DataFrame) -> DataFrame:
    """Distinct hashes without a reusable vector: what has to be embedded."""
    return chunks.select("content_hash").distinct().join(reusable.select("content_hash").distinct(), "content_hash", "left_anti")


def attached(chunks: DataFrame, reusable: DataFrame, fresh: DataFrame) -> DataFrame:
    """chunks with their vector, fresh ones going before reused ones, and whether it was reused."""
    known = reusable.select("content_hash", F.col("embedding").alias("old"))
    new = fresh.select("content_hash", F.col("embedding").alias("new"))
    joined = chunks.drop("embedding").join(known, "content_hash", "left").join(new, "content_hash", "left")
    return joined.withColumn("embedding", F.coalesce("new", "old")).withColumn("embedding_reused", F.col("new").isNull() & F.col("old").isNotNull()).drop("old", "new")


def reuse_counts(chunks: DataFrame, reusable: DataFrame, keys: list[str]) -> DataFrame:
    """Per source: chunks, reused and embedded ones (with repeats), and requests (distinct missing hashes)."""
    known = reusable.select("content_hash").distinct().withColumn("known", F.lit(True))
    joined = chunks.join(known, "content_hash", "left")
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("chunk_count"),
        F.count_if(F.col("known").isNotNull()).alias("reused_count"),
        F.count_if(F.col("known").isNull()).alias("embedded_count"),
        F.count_distinct(F.when(F.col("known").isNull(), F.col("content_hash"))).alias("request_count"),
    )
