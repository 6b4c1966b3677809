"""Queries on changes between full deliveries, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.operators.snapshots import snapshot_changes
from siltstone.session import table


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    return snapshot_changes(table(spark, base, "run_documents"), table(spark, base, "kb_runs"))


_STEPS = """
WITH full_runs AS (
  SELECT DISTINCT index_name, id, started_at FROM kb_runs
  WHERE finished_at IS NOT NULL AND lifecycle_status IN ('complete', 'activated', 'superseded')
), numbered AS (
  SELECT index_name, id AS run_id,
    row_number() OVER (PARTITION BY index_name ORDER BY started_at, id) AS seq FROM full_runs
), listed AS (
  SELECT n.index_name, n.seq, n.run_id, lower(trim(d.source_id, E' \\t\\n\\r')) AS source_id,
    regexp_replace(trim(d.canonical_url, E' \\t\\n\\r'), '#.*$', '', 's') AS bare,
    lower(d.normalized_content_hash) AS hash, d.created_at, d.id
  FROM run_documents d JOIN numbered n ON d.run_id = n.run_id
), keyed AS (
  SELECT index_name, seq, run_id, source_id,
    lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1))
      || substr(bare, length(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) + 1) AS canonical_url,
    hash, created_at, id
  FROM listed
), states AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY index_name, seq, source_id, canonical_url
    ORDER BY created_at DESC NULLS LAST, hash DESC NULLS LAST, id DESC NULLS LAST) = 1
), steps AS (
  SELECT b.index_name, b.run_id, b.seq FROM numbered b WHERE b.seq > 1
), added AS (
  SELECT s.run_id, c.source_id, c.canonical_url, c.hash FROM steps s
  JOIN states c ON c.index_name = s.index_name AND c.seq = s.seq
  WHERE NOT EXISTS (SELECT 1 FROM states p WHERE p.index_name = s.index_name AND p.seq = s.seq - 1
    AND p.source_id = c.source_id AND p.canonical_url = c.canonical_url)
), removed AS (
  SELECT s.run_id, p.source_id, p.canonical_url, p.hash FROM steps s
  JOIN states p ON p.index_name = s.index_name AND p.seq = s.seq - 1
  WHERE NOT EXISTS (SELECT 1 FROM states c WHERE c.index_name = s.index_name AND c.seq = s.seq
    AND p.source_id = c.source_id AND p.canonical_url = c.canonical_url)
), changed AS (
  SELECT s.run_id, c.source_id, c.canonical_url FROM steps s
  JOIN states c ON c.index_name = s.index_name AND c.seq = s.seq
  JOIN states p ON p.index_name = s.index_name AND p.seq = s.seq - 1
    AND p.source_id = c.source_id AND p.canonical_url = c.canonical_url
  WHERE c.hash IS DISTINCT FROM p.hash
), events AS (
  SELECT run_id, 'added' AS change_type, source_id, canonical_url, '' AS previous_url FROM added
  UNION ALL SELECT run_id, 'removed', source_id, canonical_url, '' FROM removed
  UNION ALL SELECT run_id, 'changed', source_id, canonical_url, '' FROM changed
  UNION SELECT a.run_id, 'moved', a.source_id, a.canonical_url, r.canonical_url
    FROM added a JOIN removed r ON a.run_id = r.run_id AND a.hash = r.hash
)
"""


def queries() -> dict:
    return {"p1_found": p1_found}


def oracle_sql() -> dict:
    return {"p1_found": _STEPS + "SELECT DISTINCT run_id, change_type, source_id, canonical_url, previous_url FROM events"}
