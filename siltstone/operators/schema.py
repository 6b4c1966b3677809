"""Typed schemas of the tables at rest, the live view, and SQL-side registrations."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from siltstone.functions import text, tokens, vectors
from siltstone.operators import search
from siltstone.operators.chunking import chunks_of
from siltstone.operators.html_blocks import paragraph_blocks

BLOCK = "array<struct<type:string,text:string,heading_path:array<string>>>"
FINDING = "array<struct<check:string,verdict:string,actual:double,threshold:double>>"
TABLES = {
    "indexes": "name string, live_run_id string, previous_live_run_id string, embedding_dimensions int, created_at timestamp, updated_at timestamp",
    "runs": "id string, index_name string, lifecycle_status string, verification_verdict string, embedding_dimensions int, embedding_fingerprint string, structural_config_hash string, started_at timestamp, finished_at timestamp, activated_at timestamp, rejected_at timestamp, error_summary string, metadata string",
    "sources": "run_id string, source_id string, source_type string, processed long, document_count long, error_count long, skipped_count long, empty_or_short_document_count long",
    "documents": "id string, run_id string, source_id string, external_id string, canonical_url string, title string, locale string, language_source string, language_confidence double, normalized_content_hash string, raw_content_hash string, metadata string",
    "chunks": "chunk_id long, run_id string, document_id string, source_id string, chunk_index int, chunk_count int, content_hash string, content string, estimated_tokens int, heading_path array<string>, metadata string, embedding array<float>",
    "centroids": "run_id string, cell int, centroid array<float>, angle double",
    "diffs": "run_id string, change_type string, source_id string, canonical_url string, title string, locale string, previous_source_id string, previous_url string, previous_hash string, current_hash string",
    "verifications": f"run_id string, deterministic_verdict string, llm_verdict string, final_verdict string, findings {FINDING}, input_hash string, result_source string, attestor string",
    "attestations": "input_hash string, attestor string, payload string, created_at timestamp, last_used_at timestamp",
    "reports": "run_id string, summary string, report string",
    "events": "event_id long, run_id string, kind string, at timestamp, details string",
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A table without rows, as a migration creates it."""
    return spark.createDataFrame([], TABLES[table])


def conforms(df: DataFrame, table: str) -> DataFrame:
    """df with the columns of a table in their order and types; missing ones are null, others left out."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(TABLES[table])
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def duplicate_keys(documents: DataFrame) -> DataFrame:
    """Identities that stand more than once in a run; a sound run has none."""
    return documents.groupBy("run_id", "source_id", "canonical_url").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def lock_key_column(index_name: Column) -> Column:
    """A stable 64-bit number for an index, as hexadecimal digits."""
    return F.substring(F.sha2(F.concat(F.lit("index:"), index_name), 256), 1, 16)


@udtf(returnType="chunk_index int, content string, content_hash string, estimated_tokens int")
class ChunkText:
    """Chunks of plain text, for lateral joins in SQL: chunk_text(text, budget)."""

    def eval(self, content: str, budget: int) -> Iterator[tuple]:
        for c in chunks_of(paragraph_blocks(content), budget):
            yield c["chunk_index"], c["content"], c["content_hash"], c["estimated_tokens"]


def register(spark: SparkSession) -> None:
    """chunk_text as a table function and nfkc as a function of SQL."""
    spark.udtf.register("chunk_text", ChunkText)
    spark.udf.register("nfkc", text.nfkc)


def register_live_view(spark: SparkSession, chunks: DataFrame, indexes: DataFrame, documents: DataFrame, name: str = "live_chunks", dimensions: int | None = None) -> DataFrame:
    """The view that clients read: chunks of live runs, of one vector size if given."""
    view = search.live_chunks(chunks, indexes, documents)
    if dimensions is not None:
        view = view.filter(vectors.of_size(F.col("embedding"), dimensions))
    view.createOrReplaceTempView(name)
    return view


def with_estimates(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("estimated_tokens", tokens.estimate(F.col("content")))
