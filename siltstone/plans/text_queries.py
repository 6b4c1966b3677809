"""Queries of text, token, URL and extraction operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import globs, text, tokens, urls, vectors
from siltstone.operators import pipeline
from siltstone.session import table
from siltstone.sources.files import content_type

_SQL: dict[str, str] = {}
_QUERIES: dict = {}


def query(sql: str | None = None):
    def keep(function):
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return keep


@query("SELECT doc_id, sha256(coalesce(text, '')) AS content_hash FROM documents")
def content_hash(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query(
    """SELECT doc_id, CAST(greatest(1, ceil(
      list_sum(list_transform(list_filter(string_split_regex(coalesce(text, ''), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''),
        lambda w: CASE WHEN length(w) <= 4 THEN 1 WHEN length(w) <= 8 THEN 2 WHEN length(w) <= 12 THEN 3 ELSE CAST(ceil(length(w) / 4.0) AS INT) END))::DOUBLE
      * CASE WHEN regexp_matches(coalesce(text, ''), '[^\\p{L}\\p{N}\\s]') THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END
      * CASE WHEN regexp_matches(coalesce(text, ''), '[^\\x00-\\x7F]') THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END * 1.3::DOUBLE)) AS INT) AS tokens
    FROM documents"""
)
def token_estimate(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", tokens.estimate(F.col("text")).alias("tokens"))


@query(
    """SELECT doc_id, CAST(len(list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)),
      lambda s: trim(s) <> '')) AS INT) AS sentences FROM documents"""
)
def sentence_count(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", F.size(tokens.sentences(F.col("text"))).alias("sentences"))


@query(
    """SELECT doc_id, CAST(len(list_filter(list_transform(string_split_regex(coalesce(text, ''), '\\n[ \\t\\n\\x0B\\f\\r]*\\n'),
      lambda p: trim(regexp_replace(p, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))), lambda p: p <> '')) AS INT) AS paragraphs FROM documents"""
)
def paragraph_count(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", F.size(text.paragraphs(F.col("text"))).alias("paragraphs"))


@query(
    """SELECT doc_id, trim(regexp_replace(translate(regexp_replace(regexp_replace(text, '[\\x{200B}\\x{200C}\\x{200D}\\x{FEFF}]', '', 'g'),
      '[\\x00-\\x1f\\x7f]', ' ', 'g'), '‘’‚‛“”„‟', '''''''''""\""'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS visible FROM documents"""
)
def visible_text(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", text.normalize_text(F.col("text"), fold=False).alias("visible"))


@query()
def normalized_text(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("normalized"))


@query(
    """SELECT DISTINCT u AS canonical_url, lower(nullif(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1), '')) AS host,
      nullif(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+', 0), '') AS origin,
      CASE WHEN regexp_matches(u, '^(?i)https?://') THEN lower(nullif(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1), '')) END AS web_host,
      regexp_replace(u, '[?#].*$', '') AS reportable
    FROM (SELECT trim(canonical_url, E' \\t\\n\\r') AS u FROM run_documents)"""
)
def url_parts(spark: SparkSession, base: str) -> DataFrame:
    u = F.regexp_replace("canonical_url", r"^\s+|\s+$", "")
    return table(spark, base, "run_documents").select(u.alias("canonical_url"), urls.host(u).alias("host"), urls.origin(u).alias("origin"), urls.web_host(u).alias("web_host"), urls.reportable(u).alias("reportable")).distinct()


@query(
    """SELECT DISTINCT canonical_url, nullif(regexp_extract(canonical_url, '/kb/([^/?#]+)', 1), '') AS after_kb,
      coalesce(nullif(regexp_extract(canonical_url, '/article/(\\d+)', 1), ''), nullif(regexp_extract(canonical_url, '/articles/view/(\\d+)', 1), ''),
        nullif(regexp_extract(canonical_url, '/kb/view/(\\d+)', 1), ''), nullif(regexp_extract(canonical_url, '/pages/(\\d+)', 1), ''),
        nullif(regexp_extract(canonical_url, '/wiki/spaces/[^/]+/pages/(\\d+)', 1), '')) AS article_id,
      regexp_replace(canonical_url, '^.*/', '') AS base_name
    FROM run_documents"""
)
def url_identifiers(spark: SparkSession, base: str) -> DataFrame:
    u = F.col("canonical_url")
    return table(spark, base, "run_documents").select(u, urls.segment_after(u, "kb").alias("after_kb"), urls.article_id(u).alias("article_id"), text.base_name(u).alias("base_name")).distinct()


@query(
    """SELECT source_id, count(*) AS rows, count(*) FILTER (WHERE length(canonical_url) > 0
        AND (starts_with(canonical_url, 'https://help.') OR starts_with(canonical_url, 'https://support.') OR starts_with(canonical_url, 'https://docs.'))
        AND NOT starts_with(canonical_url, 'https://support.vankest')) AS allowed,
      count(*) FILTER (WHERE regexp_matches(canonical_url, '^https://[^/]*/docs/[^/]*$') OR regexp_matches(canonical_url, '^(?:.*/)?kb/.*$')) AS globbed
    FROM run_documents GROUP BY source_id"""
)
def url_filters(spark: SparkSession, base: str) -> DataFrame:
    u = F.col("canonical_url")
    ok = urls.allowed(u, ["https://help.", "https://support.", "https://docs."], None, ["https://support.vankest"])
    glob = globs.included(u, ["https://*/docs/*", "**/kb/**"])
    return table(spark, base, "run_documents").groupBy("source_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("allowed"), F.count_if(glob).alias("globbed"))


@query(
    """SELECT locale, nullif(lower(split_part(replace(locale, '_', '-'), '-', 1)), '') AS tag, count(*) AS records
    FROM extracted_documents GROUP BY locale"""
)
def locale_tags(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "extracted_documents").groupBy("locale").agg(F.count(F.lit(1)).alias("records")).withColumn("tag", text.locale_subtag(F.col("locale")))


@query(
    """SELECT extract_id, CASE WHEN length(title) > 40 THEN substr(title, 1, 37) || '...' ELSE title END AS shortened,
      replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped,
      regexp_replace(title, '([\\\\\\[\\]])', '\\\\\\1', 'g') AS link_text, replace(replace(title, 'the', ' '), '(', ' ') AS stripped,
      trim(regexp_replace(lower(coalesce(title, '')), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS ready
    FROM (SELECT DISTINCT extract_id, title FROM extracted_documents)"""
)
def title_forms(spark: SparkSession, base: str) -> DataFrame:
    t = F.col("title")
    return table(spark, base, "extracted_documents").select("extract_id", "title").distinct().select(
        "extract_id", text.shortened(t, 40).alias("shortened"), text.markup_escaped(t).alias("escaped"), text.link_text_escaped(t).alias("link_text"), text.without_phrases(t, ["the", "("]).alias("stripped"), text.readiness_text(t).alias("ready")
    )


@query(
    """SELECT source_type, name, CASE lower(regexp_extract(name, '\\.([^.]+)$', 1)) WHEN 'html' THEN 'text/html' WHEN 'md' THEN 'text/markdown'
      WHEN 'json' THEN 'application/json' WHEN 'txt' THEN 'text/plain' ELSE 'application/octet-stream' END AS content_type
    FROM (SELECT DISTINCT source_type, source_id || e AS name FROM kb_sources, (SELECT unnest(['.html', '.md', '.JSON', '.txt', '.bin', '']) AS e))"""
)
def file_content_types(spark: SparkSession, base: str) -> DataFrame:
    names = table(spark, base, "kb_sources").select("source_type", "source_id", F.explode(F.array(*[F.lit(e) for e in (".html", ".md", ".JSON", ".txt", ".bin", "")])).alias("e"))
    named = names.select("source_type", F.concat("source_id", "e").alias("name")).distinct()
    return named.withColumn("content_type", content_type(F.col("name")))


@query(
    """SELECT DISTINCT chunk_id, coalesce(len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL)) = 0, false) AS of_size FROM chunks"""
)
def vector_sizes(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "chunks").select("chunk_id", vectors.of_size(F.col("embedding"), 64).alias("of_size")).distinct()


@query(
    """SELECT DISTINCT page_id, list_transform(blocks, lambda b: b.text) AS texts, CAST(len(blocks) AS INT) AS blocks
    FROM pages WHERE len(blocks) > 0 AND (starts_with(content_type, 'text/html') OR starts_with(content_type, 'application/xhtml'))"""
)
def html_blocks(spark: SparkSession, base: str) -> DataFrame:
    """Blocks extracted from the HTML bodies; the table's own blocks are the expectation."""
    pages = table(spark, base, "pages").filter(F.col("content_type").startswith("text/html") | F.col("content_type").startswith("application/xhtml"))
    found = pipeline.documents(pages.select("page_id", "canonical_url", "title", "content_type", "body")).filter("outcome = 'document'")
    return found.select("page_id", F.transform("new_blocks", lambda b: b["text"]).alias("texts"), F.size("new_blocks").alias("blocks")).distinct()


@query(
    r"""SELECT DISTINCT page_id, source_id, CASE WHEN len(blocks) > 0 THEN 'document' ELSE 'skipped' END AS outcome,
      CASE WHEN coalesce(title, '') <> '' THEN title WHEN starts_with(content_type, 'text/html') OR starts_with(content_type, 'application/xhtml') THEN
        nullif(trim(replace(replace(replace(replace(replace(regexp_extract(body, '<title>([^<]*)</title>', 1), '&#x27;', chr(39)), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')), '') END AS doc_title,
      CASE WHEN starts_with(content_type, 'text/html') OR starts_with(content_type, 'application/xhtml') THEN nullif(regexp_extract(body, '<html[^>]*\slang="([^"]*)"', 1), '') END AS html_locale,
      sha256(array_to_string(list_transform(coalesce(blocks, []), lambda b: b.text), ' ')) AS normalized_content_hash, CAST(len(coalesce(blocks, [])) AS INT) AS blocks
    FROM pages"""
)
def page_documents(spark: SparkSession, base: str) -> DataFrame:
    found = pipeline.documents(table(spark, base, "pages").select("page_id", "source_id", "canonical_url", "title", "content_type", "body"))
    return found.select("page_id", "source_id", "outcome", "doc_title", "html_locale", "normalized_content_hash", F.size("new_blocks").alias("blocks")).distinct()


@query()
def chunked(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "extracted_documents").select("extract_id", "blocks").filter("blocks is not null")
    return pipeline.chunks(docs, 200).select("extract_id", "chunk_index", "chunk_count", "content_hash", "estimated_tokens", "heading_path").distinct()


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)
