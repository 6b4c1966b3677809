"""Queries of the relational operators of a refresh, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.operators import dedupe, diff, gate, pipeline, reuse, search, store, vector_index
from siltstone.operators.snapshots import canonical_address, canonical_source
from siltstone.session import stored, table
from siltstone.streaming import refresh as streaming

_SQL: dict[str, str] = {}
_QUERIES: dict = {}


def query(sql: str | None = None):
    def keep(function):
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return keep


# --- the live and the previous live run of each index, one row for each document

LIVE = r"""
WITH pointers AS (SELECT DISTINCT name, live_run_id, previous_live_run_id FROM kb_indexes),
listed AS (
  SELECT d.run_id, lower(trim(d.source_id, E' \t\n\r')) AS source_id, regexp_replace(trim(d.canonical_url, E' \t\n\r'), '#.*$', '', 's') AS bare,
    d.title, d.locale, lower(d.normalized_content_hash) AS hash, d.created_at, d.id, d.external_id
  FROM run_documents d
), keyed AS (
  SELECT *, lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) || substr(bare, length(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) + 1) AS canonical_url
  FROM listed
), states AS (
  SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY run_id, source_id, canonical_url
    ORDER BY created_at DESC NULLS LAST, hash DESC NULLS LAST, id DESC NULLS LAST, title DESC NULLS LAST) = 1
), cur AS (SELECT s.* FROM states s JOIN pointers p ON s.run_id = p.live_run_id),
prev AS (SELECT s.* FROM states s JOIN pointers p ON s.run_id = p.previous_live_run_id),
added AS (SELECT c.* FROM cur c WHERE NOT EXISTS (SELECT 1 FROM prev p WHERE p.source_id = c.source_id AND p.canonical_url = c.canonical_url)),
removed AS (SELECT p.* FROM prev p WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE p.source_id = c.source_id AND p.canonical_url = c.canonical_url)),
diff AS (
  SELECT 'added' AS change_type, source_id, canonical_url, title, locale, NULL::VARCHAR AS previous_source_id, NULL::VARCHAR AS previous_url, NULL::VARCHAR AS previous_hash, hash AS current_hash FROM added
  UNION ALL SELECT 'removed', source_id, canonical_url, NULL, NULL, NULL, NULL, hash, NULL FROM removed
  UNION ALL SELECT 'changed', c.source_id, c.canonical_url, c.title, c.locale, NULL, NULL, p.hash, c.hash FROM cur c JOIN prev p
    ON p.source_id = c.source_id AND p.canonical_url = c.canonical_url WHERE p.hash IS DISTINCT FROM c.hash
  UNION ALL SELECT 'moved', a.source_id, a.canonical_url, a.title, a.locale, r.source_id, r.canonical_url, a.hash, a.hash FROM added a JOIN removed r ON a.hash = r.hash
)
"""


def live_sides(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(previous, current): the documents of the previous live and the live runs, the latest row of each identity."""
    pointers = table(spark, base, "kb_indexes").select("name", "live_run_id", "previous_live_run_id").distinct()
    rows = table(spark, base, "run_documents").select(
        "run_id", canonical_source(F.col("source_id")).alias("source_id"), canonical_address(F.col("canonical_url")).alias("canonical_url"), "title", "locale",
        F.lower("normalized_content_hash").alias("normalized_content_hash"), "created_at", "id", "external_id",
    )

    def side(column: str) -> DataFrame:
        mine = rows.join(pointers.select(F.col(column).alias("run_id")), "run_id", "left_semi")
        order = [F.col(c).desc_nulls_last() for c in ("created_at", "normalized_content_hash", "id", "title")]
        return store.latest(mine, ["run_id", "source_id", "canonical_url"], order)

    return side("previous_live_run_id"), side("live_run_id")


def live_diff(spark: SparkSession, base: str) -> DataFrame:
    return diff.run_diff(*live_sides(spark, base))


@query(LIVE + "SELECT * FROM diff")
def run_diff(spark: SparkSession, base: str) -> DataFrame:
    return live_diff(spark, base)


@query(
    LIVE
    + """SELECT (SELECT count(*) FROM prev) AS previous_count, (SELECT count(*) FROM cur) AS current_count, count(*) FILTER (WHERE change_type = 'added') AS added_count,
    count(*) FILTER (WHERE change_type = 'removed') AS removed_count, count(*) FILTER (WHERE change_type = 'changed') AS changed_count, count(*) FILTER (WHERE change_type = 'moved') AS moved_count FROM diff"""
)
def diff_summary(spark: SparkSession, base: str) -> DataFrame:
    previous, current = map(stored, live_sides(spark, base))
    return diff.diff_summary(diff.run_diff(previous, current), previous, current)


@query(LIVE + "SELECT change_type, source_id, canonical_url, previous_url, row_number() OVER (PARTITION BY change_type ORDER BY canonical_url, source_id, previous_url NULLS FIRST) AS position FROM diff")
def diff_positions(spark: SparkSession, base: str) -> DataFrame:
    return diff.listed(live_diff(spark, base)).select("change_type", "source_id", "canonical_url", "previous_url", "position")


@query(
    LIVE
    + """SELECT change_type, source_id, canonical_url, previous_url, greatest(total - 50, 0)::INT AS hidden FROM (
      SELECT *, row_number() OVER (ORDER BY list_position(['added', 'removed', 'changed', 'moved'], change_type), canonical_url, source_id, previous_url NULLS FIRST) AS n, count(*) OVER () AS total FROM diff) WHERE n <= 50"""
)
def first_changes(spark: SparkSession, base: str) -> DataFrame:
    return diff.first_changes(live_diff(spark, base)).select("change_type", "source_id", "canonical_url", "previous_url", "hidden")


@query(LIVE + "SELECT source_id, canonical_url, count(DISTINCT change_type) AS entries FROM diff GROUP BY ALL")
def entry_counts(spark: SparkSession, base: str) -> DataFrame:
    return diff.entry_counts(live_diff(spark, base))


@query(LIVE + "SELECT source_id, canonical_url, title FROM cur c WHERE EXISTS (SELECT 1 FROM diff d WHERE d.change_type IN ('added', 'changed', 'moved') AND d.source_id = c.source_id AND d.canonical_url = c.canonical_url)")
def covered_documents(spark: SparkSession, base: str) -> DataFrame:
    previous, current = live_sides(spark, base)
    return diff.covered(current, diff.run_diff(previous, current)).select("source_id", "canonical_url", "title")


@query(LIVE + "SELECT change_type, source_id, canonical_url FROM diff d WHERE change_type = 'removed' OR NOT EXISTS (SELECT 1 FROM cur c WHERE c.locale = 'en' AND d.source_id = c.source_id AND d.canonical_url = c.canonical_url)")
def uncovered_entries(spark: SparkSession, base: str) -> DataFrame:
    """Entries that no English document stands for."""
    previous, current = live_sides(spark, base)
    return diff.uncovered(diff.run_diff(previous, current), current.filter("locale = 'en'")).select("change_type", "source_id", "canonical_url")


@query(
    LIVE
    + """SELECT c.source_id, c.canonical_url, CAST(count(d.change_type) AS INT) AS entries, coalesce(string_agg(d.change_type, ',' ORDER BY d.change_type), '') AS classes
    FROM cur c LEFT JOIN diff d ON d.source_id = c.source_id AND d.canonical_url = c.canonical_url GROUP BY ALL"""
)
def annotated_documents(spark: SparkSession, base: str) -> DataFrame:
    previous, current = live_sides(spark, base)
    found = diff.annotated(current, diff.run_diff(previous, current))
    return found.select("source_id", "canonical_url", F.size("entries").alias("entries"), F.array_join(F.transform("entries", lambda e: e["change_type"]), ",").alias("classes"))


@query(
    LIVE
    + """SELECT source_id, title, canonical_url FROM (SELECT c.source_id, c.title, c.canonical_url, row_number() OVER (PARTITION BY c.source_id, c.title ORDER BY c.canonical_url) AS nth FROM cur c) m
    WHERE nth > (SELECT count(*) FROM prev p WHERE p.source_id = m.source_id AND p.title IS NOT DISTINCT FROM m.title)"""
)
def multiset_difference(spark: SparkSession, base: str) -> DataFrame:
    """Titles of live documents beyond those of the previous live run, by source."""
    previous, current = live_sides(spark, base)
    return diff.multiset_difference(current.select("source_id", "title", "canonical_url"), previous, ("source_id",), "title", "canonical_url")


@query(
    r"""WITH lines AS (
      SELECT doc_id, unnest(range(1, len(parts) + 1)) AS position, unnest(parts) AS segment FROM (
        SELECT doc_id, list_filter(list_transform(string_split_regex(coalesce(text, ''), '\r\n|\n|\r'), lambda s: trim(s)), lambda s: s <> '') AS parts FROM documents)
    ), run AS (
      SELECT *, row_number() OVER w AS n, coalesce(sum(length(segment)) OVER (PARTITION BY doc_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY position)
    )
    SELECT doc_id, CAST(count(*) FILTER (WHERE n <= 12 AND before < 600) AS INT) AS shown, count(*) FILTER (WHERE NOT (n <= 12 AND before < 600)) AS omitted,
      coalesce(string_agg(CASE WHEN length(segment) <= 600 - before THEN segment ELSE substr(segment, 1, greatest(600 - before - 1, 0)::INT) || '…' END, chr(10) ORDER BY n) FILTER (WHERE n <= 12 AND before < 600), '') AS evidence
    FROM run GROUP BY doc_id"""
)
def bounded_evidence(spark: SparkSession, base: str) -> DataFrame:
    """The first 12 lines of each document within 600 characters, and the number left out."""
    lines = table(spark, base, "documents").select("doc_id", F.posexplode(diff.segments(F.col("text"))).alias("position", "segment"))
    found = diff.bounded(lines, ("doc_id",), "segment", "position", 12, 600)
    return found.select("doc_id", F.size("segments").alias("shown"), "omitted", F.array_join("segments", "\n").alias("evidence"))


# --- keep-first and best-of-group

@query(
    """SELECT id, run_id, external_id FROM run_documents QUALIFY external_id IS NULL OR row_number() OVER (PARTITION BY external_id
      ORDER BY -(CAST(contains(canonical_url, '/docs/') AS INT) + CAST(contains(canonical_url, 'lang=en') AS INT)), length(canonical_url), canonical_url, id, run_id, source_id) = 1"""
)
def dedupe_by_external_id(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "run_documents")
    url = F.col("canonical_url")
    order = Window.partitionBy("external_id").orderBy(dedupe.preference(url, ["/docs/", "lang=en"]), "id", "run_id", "source_id")
    named = rows.filter("external_id is not null").withColumn("n", F.row_number().over(order)).filter("n = 1")
    return named.select("id", "run_id", "external_id").unionByName(rows.filter("external_id is null").select("id", "run_id", "external_id"))


@query(
    """SELECT doc_id, source FROM (SELECT doc_id, source, sha256(text) AS h FROM documents) QUALIFY h IS NULL OR row_number() OVER (PARTITION BY h ORDER BY length(source || '/' || doc_id), source || '/' || doc_id) = 1"""
)
def dedupe_by_content(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"), F.concat_ws("/", "source", "doc_id").alias("url"))
    return dedupe.best_of(rows, "h", url="url").select("doc_id", "source")


@query("SELECT source_id, canonical_url, id FROM (SELECT DISTINCT source_id, canonical_url, id FROM run_documents) QUALIFY canonical_url IS NULL OR row_number() OVER (PARTITION BY canonical_url ORDER BY id, source_id) = 1")
def first_by_url(spark: SparkSession, base: str) -> DataFrame:
    items = table(spark, base, "run_documents").select("source_id", "canonical_url", "id").distinct()
    return dedupe.first_by_url(items.withColumn("order", F.struct("id", "source_id")), "order").select("source_id", "canonical_url", "id")


@query(
    """SELECT source_id, count(*) AS processed, count(*) FILTER (WHERE outcome = 'document') AS document_count, count(*) FILTER (WHERE outcome = 'error') AS error_count,
      count(*) FILTER (WHERE outcome = 'skipped') AS skipped_count, count(*) FILTER (WHERE outcome = 'skipped') AS empty_or_short_document_count
    FROM (SELECT DISTINCT extract_id, source_id, CASE WHEN trim(coalesce(normalized_content, ''), E' \\t\\n\\r') = '' THEN 'skipped' ELSE 'document' END AS outcome FROM extracted_documents) GROUP BY source_id"""
)
def source_stats(spark: SparkSession, base: str) -> DataFrame:
    blank = F.regexp_replace(F.coalesce("normalized_content", F.lit("")), r"^[ \t\n\r]+", "") == ""
    rows = table(spark, base, "extracted_documents").select("extract_id", "source_id", F.when(blank, "skipped").otherwise("document").alias("outcome"), blank.alias("empty_or_short_document")).distinct()
    return pipeline.source_counts(rows, ["source_id"])


# --- reuse of vectors

REUSE = """
WITH runs AS (SELECT DISTINCT id, index_name, embedding_dimensions, json_extract_string(metadata, '$.embedding_fingerprint') AS embedding_fingerprint, started_at FROM kb_runs WHERE lifecycle_status IN ('complete', 'activated', 'superseded')),
candidates AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY index_name, embedding_dimensions, embedding_fingerprint ORDER BY started_at DESC, id DESC) <= 5),
reusable AS (
  SELECT r.index_name, c.content_hash, c.run_id, c.chunk_id FROM chunks c JOIN candidates r ON c.run_id = r.id WHERE c.embedding IS NOT NULL AND c.content_hash IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r.index_name, c.content_hash ORDER BY r.started_at DESC, c.run_id DESC, c.chunk_id) = 1
)
"""


def _candidates(spark: SparkSession, base: str) -> DataFrame:
    return reuse.candidate_runs(table(spark, base, "kb_runs"))


@query(REUSE + "SELECT id, index_name, embedding_fingerprint FROM candidates")
def reuse_candidates(spark: SparkSession, base: str) -> DataFrame:
    return _candidates(spark, base).select("id", "index_name", "embedding_fingerprint")


@query(REUSE + "SELECT index_name, content_hash, run_id FROM reusable")
def reusable_embeddings(spark: SparkSession, base: str) -> DataFrame:
    return reuse.reusable_vectors(table(spark, base, "chunks"), _candidates(spark, base)).select("index_name", "content_hash", "run_id")


@query(REUSE + "SELECT DISTINCT content_hash FROM chunks c WHERE content_hash IS NOT NULL AND NOT EXISTS (SELECT 1 FROM reusable r WHERE r.content_hash = c.content_hash)")
def missing_hashes(spark: SparkSession, base: str) -> DataFrame:
    chunks = table(spark, base, "chunks").filter("content_hash is not null")
    return reuse.missing_hashes(chunks, reuse.reusable_vectors(chunks, _candidates(spark, base)))


@query(
    """WITH known AS (SELECT DISTINCT c.content_hash FROM chunks c JOIN kb_indexes i ON c.run_id = i.previous_live_run_id WHERE c.embedding IS NOT NULL)
    SELECT source_id, count(*) AS chunk_count, count(k.content_hash) AS reused_count, count(*) FILTER (WHERE k.content_hash IS NULL) AS embedded_count,
      count(DISTINCT CASE WHEN k.content_hash IS NULL THEN c.content_hash END) AS request_count
    FROM (SELECT DISTINCT chunk_id, source_id, run_id, content_hash FROM chunks) c JOIN (SELECT DISTINCT live_run_id FROM kb_indexes) i ON c.run_id = i.live_run_id LEFT JOIN known k ON k.content_hash = c.content_hash GROUP BY source_id"""
)
def embedding_reuse_counts(spark: SparkSession, base: str) -> DataFrame:
    """What of the live chunks could be taken from the previous live run."""
    chunks = table(spark, base, "chunks")
    pointers = table(spark, base, "kb_indexes")
    known = chunks.filter("embedding is not null").join(pointers.select(F.col("previous_live_run_id").alias("run_id")).distinct(), "run_id", "left_semi")
    now = chunks.select("chunk_id", "source_id", "run_id", "content_hash").distinct().join(pointers.select(F.col("live_run_id").alias("run_id")).distinct(), "run_id", "left_semi")
    return reuse.reuse_counts(now, known, ["source_id"])


@query(
    """WITH known AS (SELECT c.content_hash, min(c.chunk_id) AS giver FROM chunks c JOIN kb_indexes i ON c.run_id = i.previous_live_run_id WHERE c.embedding IS NOT NULL GROUP BY ALL)
    SELECT c.chunk_id, k.content_hash IS NOT NULL AS embedding_reused FROM (SELECT DISTINCT chunk_id, run_id, content_hash FROM chunks) c JOIN (SELECT DISTINCT live_run_id FROM kb_indexes) i ON c.run_id = i.live_run_id LEFT JOIN known k ON k.content_hash = c.content_hash"""
)
def attached_embeddings(spark: SparkSession, base: str) -> DataFrame:
    chunks, pointers = table(spark, base, "chunks"), table(spark, base, "kb_indexes")
    before = chunks.filter("embedding is not null").join(pointers.select(F.col("previous_live_run_id").alias("run_id")).distinct(), "run_id", "left_semi")
    known = before.groupBy("content_hash").agg(F.min_by("embedding", "chunk_id").alias("embedding"))
    now = chunks.select("chunk_id", "run_id", "content_hash").distinct().join(pointers.select(F.col("live_run_id").alias("run_id")).distinct(), "run_id", "left_semi")
    return reuse.attached(now, known, known.limit(0)).select("chunk_id", "embedding_reused")


# --- gates and verdicts

GATE = (
    LIVE
    + """, sizes AS (SELECT source_id, count(*) AS previous_count FROM prev GROUP BY ALL), classes AS (SELECT source_id, count(*) FILTER (WHERE change_type = 'removed') AS removed_count, count(*) FILTER (WHERE change_type = 'changed') AS changed_count FROM diff GROUP BY ALL),
counts AS (SELECT c.source_id, count(*) AS document_count, count(*) FILTER (WHERE c.hash IS NULL) AS error_count, count(*) FILTER (WHERE c.title IS NULL) AS skipped_count, count(*) FILTER (WHERE c.title IS NULL) AS empty_count FROM cur c GROUP BY ALL),
rows AS (SELECT c.*, coalesce(s.previous_count, 0) AS previous_count, coalesce(k.removed_count, 0) AS removed_count, coalesce(k.changed_count, 0) AS changed_count FROM counts c LEFT JOIN sizes s USING (source_id) LEFT JOIN classes k USING (source_id))
SELECT source_id, list_aggregate(list_filter([CASE WHEN document_count = 0 THEN 'zero_documents' END, CASE WHEN removed_count > 5 THEN 'max_removed_absolute' END, CASE WHEN previous_count > 0 AND removed_count / previous_count > 0.05 THEN 'max_removed_percentage' END,
  CASE WHEN previous_count > 0 AND changed_count / previous_count > 0.1 THEN 'max_changed_percentage' END, CASE WHEN error_count / (document_count + error_count + skipped_count) > 0.02 THEN 'max_item_failure_percentage' END,
  CASE WHEN empty_count / (document_count + error_count + skipped_count) > 0.03 THEN 'max_empty_or_short_document_percentage' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS checks,
  CASE WHEN document_count = 0 THEN 'fail' WHEN checks IS NULL OR checks = '' THEN 'pass' ELSE 'caution' END AS verdict FROM rows"""
)


@query(GATE)
def deterministic_gate(spark: SparkSession, base: str) -> DataFrame:
    """The gate over each source of the live runs: missing hashes as failures, missing titles as empty documents."""
    previous, current = map(stored, live_sides(spark, base))
    changes = diff.run_diff(previous, current)
    sizes = previous.groupBy("source_id").agg(F.count(F.lit(1)).alias("previous_count"))
    classes = changes.groupBy("source_id").agg(*[F.count_if(F.col("change_type") == c).alias(f"{c}_count") for c in ("removed", "changed")])
    counts = current.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("document_count"),
        F.count_if(F.col("normalized_content_hash").isNull()).alias("error_count"),
        F.count_if(F.col("title").isNull()).alias("skipped_count"),
        F.count_if(F.col("title").isNull()).alias("empty_or_short_document_count"),
    )
    rows = counts.join(sizes, "source_id", "left").join(classes, "source_id", "left").fillna(0)
    found = gate.gated(rows, gate.Thresholds(5, 0.05, 0.1, 0.02, 0.03))
    return found.select("source_id", F.nullif(F.array_join(F.transform("findings", lambda f: f["check"]), ","), F.lit("")).alias("checks"), "verdict")


BATCHES = "(SELECT DISTINCT id, index_name, verification_verdict AS verdict, coalesce(error_summary, lifecycle_status) AS reasoning, row_number() OVER (PARTITION BY index_name ORDER BY started_at, id) AS batch FROM (SELECT DISTINCT id, index_name, verification_verdict, error_summary, lifecycle_status, started_at FROM kb_runs) WHERE verification_verdict IS NOT NULL)"


def _batches(spark: SparkSession, base: str) -> DataFrame:
    runs = table(spark, base, "kb_runs").select("id", "index_name", "verification_verdict", "error_summary", "lifecycle_status", "started_at").distinct().filter("verification_verdict is not null")
    order = Window.partitionBy("index_name").orderBy("started_at", "id")
    return runs.select("index_name", F.col("verification_verdict").alias("verdict"), F.coalesce("error_summary", "lifecycle_status").alias("reasoning"), F.row_number().over(order).alias("batch"))


@query(
    f"""SELECT index_name, count(*) FILTER (WHERE verdict = 'pass') AS pass_count, count(*) FILTER (WHERE verdict = 'caution') AS caution_count, count(*) FILTER (WHERE verdict = 'fail') AS fail_count,
    ['pass', 'caution', 'fail'][max(list_position(['pass', 'caution', 'fail'], verdict))] AS verdict FROM {BATCHES} GROUP BY index_name"""
)
def batch_summary(spark: SparkSession, base: str) -> DataFrame:
    return gate.batch_summary(_batches(spark, base), ["index_name"])


@query(f"SELECT index_name, verdict, reasoning, CAST(min(batch) AS INT) AS first_batch, string_agg(batch, ',' ORDER BY batch) AS batches FROM {BATCHES} WHERE verdict <> 'pass' GROUP BY ALL")
def reason_groups(spark: SparkSession, base: str) -> DataFrame:
    return gate.reason_groups(_batches(spark, base), ["index_name"]).withColumn("batches", F.array_join("batches", ","))


@query(f"SELECT index_name, reasoning, CAST(min(batch) AS INT) AS first_batch, string_agg(batch, ',' ORDER BY batch) AS batches FROM {BATCHES} WHERE verdict = 'pass' AND trim(coalesce(reasoning, '')) <> '' GROUP BY ALL")
def pass_groups(spark: SparkSession, base: str) -> DataFrame:
    return gate.pass_groups(_batches(spark, base), ["index_name"]).withColumn("batches", F.array_join("batches", ","))


# --- runs

@query("SELECT DISTINCT i.name AS index_name, r.id, r.lifecycle_status, r.verification_verdict, json_extract_string(r.metadata, '$.embedding_fingerprint') AS embedding_fingerprint, coalesce(CAST(json_extract(r.metadata, '$.auto_activate') AS BOOLEAN), false) AS auto_activate FROM kb_indexes i JOIN kb_runs r ON r.id = i.live_run_id")
def live_runs(spark: SparkSession, base: str) -> DataFrame:
    """The live run of each index with fields of its metadata."""
    pointers = table(spark, base, "kb_indexes").select(F.col("name").alias("index_name"), F.col("live_run_id").alias("id"))
    runs = table(spark, base, "kb_runs").select("id", "lifecycle_status", "verification_verdict", F.get_json_object("metadata", "$.embedding_fingerprint").alias("embedding_fingerprint"), F.coalesce(F.get_json_object("metadata", "$.auto_activate").cast("boolean"), F.lit(False)).alias("auto_activate"))
    return pointers.join(runs, "id").distinct()


@query(LIVE + "SELECT run_id, source_id, canonical_url, title, hash AS normalized_content_hash, row_number() OVER (PARTITION BY run_id ORDER BY canonical_url, source_id) AS position FROM cur")
def run_documents_in_order(spark: SparkSession, base: str) -> DataFrame:
    """The documents of the live runs in order of their addresses."""
    _, current = live_sides(spark, base)
    order = Window.partitionBy("run_id").orderBy("canonical_url", "source_id")
    return current.select("run_id", "source_id", "canonical_url", "title", "normalized_content_hash", F.row_number().over(order).alias("position"))


@query(
    """SELECT r.index_name, count(DISTINCT s.source_id) AS sources, count(DISTINCT d.id) AS documents, count(*) AS rows, count(DISTINCT d.normalized_content_hash) AS contents
    FROM run_documents d JOIN (SELECT DISTINCT id, index_name FROM kb_runs) r ON d.run_id = r.id JOIN (SELECT DISTINCT source_id, index_name FROM kb_sources) s ON s.source_id = lower(trim(d.source_id, E' \\t\\n\\r')) GROUP BY r.index_name"""
)
def crawl_summary(spark: SparkSession, base: str) -> DataFrame:
    """What the runs of each index have listed."""
    runs = table(spark, base, "kb_runs").select(F.col("id").alias("run_id"), "index_name").distinct()
    sources = table(spark, base, "kb_sources").select("source_id").distinct()
    rows = table(spark, base, "run_documents").select("run_id", canonical_source(F.col("source_id")).alias("source_id"), "id", "normalized_content_hash")
    joined = rows.join(runs, "run_id").join(sources, "source_id")
    return joined.groupBy("index_name").agg(F.count_distinct("source_id").alias("sources"), F.count_distinct("id").alias("documents"), F.count(F.lit(1)).alias("rows"), F.count_distinct("normalized_content_hash").alias("contents"))


@query(
    LIVE
    + """SELECT DISTINCT c.document_id, c.chunk_index, c.content FROM chunks c JOIN cur d ON c.document_id = d.id AND c.run_id = d.run_id
    WHERE EXISTS (SELECT 1 FROM diff x WHERE x.change_type IN ('added', 'changed', 'moved') AND x.source_id = d.source_id AND x.canonical_url = d.canonical_url)"""
)
def changed_chunk_content(spark: SparkSession, base: str) -> DataFrame:
    """The chunks of the live documents that the difference names."""
    previous, current = live_sides(spark, base)
    named = diff.covered(current, diff.run_diff(previous, current)).select(F.col("id").alias("document_id"), "run_id").distinct()
    return table(spark, base, "chunks").join(named, ["document_id", "run_id"], "left_semi").select("document_id", "chunk_index", "content").distinct()

@query("SELECT id, index_name, started_at FROM (SELECT DISTINCT id, index_name, started_at FROM kb_runs) ORDER BY started_at DESC, id DESC LIMIT 50")
def newest_runs(spark: SparkSession, base: str) -> DataFrame:
    return store.listed_runs(table(spark, base, "kb_runs").select("id", "index_name", "started_at").distinct())


@query("SELECT DISTINCT id FROM kb_runs WHERE lifecycle_status IN ('created', 'crawling', 'embedding', 'verifying') AND started_at < TIMESTAMP '2023-12-20 00:00:00' - INTERVAL 360 MINUTE")
def stale_runs(spark: SparkSession, base: str) -> DataFrame:
    from datetime import datetime

    return store.stale_runs(table(spark, base, "kb_runs"), datetime(2023, 12, 20)).select("id").distinct()


@query(
    """WITH runs AS (SELECT id, any_value(index_name) AS index_name, any_value(lifecycle_status) AS lifecycle_status, any_value(started_at) AS started_at, any_value(finished_at) AS finished_at FROM kb_runs GROUP BY id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY index_name ORDER BY started_at DESC, id DESC) AS newest FROM runs)
    SELECT r.id, r.index_name FROM ranked r JOIN (SELECT DISTINCT name, live_run_id, previous_live_run_id FROM kb_indexes) i ON r.index_name = i.name
    WHERE r.id IS DISTINCT FROM i.live_run_id AND r.id IS DISTINCT FROM i.previous_live_run_id AND r.lifecycle_status IN ('complete', 'superseded', 'rejected', 'error')
      AND coalesce(r.finished_at, r.started_at) < TIMESTAMP '2023-12-15 00:00:00' AND r.newest > 2"""
)
def prune_candidates(spark: SparkSession, base: str) -> DataFrame:
    from datetime import datetime

    found = store.prune_candidates(table(spark, base, "kb_runs"), table(spark, base, "kb_indexes"), older_than=datetime(2023, 12, 15), keep_last=2)
    return found.select("id", "index_name")


@query(
    """SELECT structural_config_hash AS input_hash, index_name AS attestor, id AS payload FROM (SELECT DISTINCT structural_config_hash, index_name, id, started_at FROM kb_runs WHERE structural_config_hash IS NOT NULL AND list_position(['wexaskmer-help', 'lanfen-partners', 'quilask-docs'], index_name) > 0)
    QUALIFY row_number() OVER (PARTITION BY structural_config_hash ORDER BY list_position(['wexaskmer-help', 'lanfen-partners', 'quilask-docs'], index_name), started_at DESC, index_name DESC, id DESC) = 1"""
)
def trusted_results(spark: SparkSession, base: str) -> DataFrame:
    """kb_runs as attestations: the index attests, the configuration's hash is the input."""
    rows = table(spark, base, "kb_runs").filter("structural_config_hash is not null").select(F.col("structural_config_hash").alias("input_hash"), F.col("index_name").alias("attestor"), F.col("started_at").alias("created_at"), F.col("id").alias("payload")).distinct()
    trusted = ["wexaskmer-help", "lanfen-partners", "quilask-docs"]
    place = F.array_position(F.array(*[F.lit(t) for t in trusted]), F.col("attestor"))
    ranked = store.latest(rows.withColumn("place", place).filter("place > 0"), ["input_hash"], [F.col("place"), F.desc("created_at"), F.desc("attestor"), F.desc("payload")])
    return ranked.select("input_hash", "attestor", "payload")


@query("SELECT structural_config_hash AS input_hash, index_name AS attestor, min(started_at) AS created_at, max(coalesce(finished_at, started_at)) AS last_used_at FROM kb_runs GROUP BY ALL")
def upserted_attestations(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "kb_runs").select(F.col("structural_config_hash").alias("input_hash"), F.col("index_name").alias("attestor"), F.col("started_at").alias("created_at"), F.coalesce("finished_at", "started_at").alias("last_used_at"), F.col("id").alias("payload"))
    return store.upserted_attestations(rows).drop("payload")


@query(
    """WITH v AS (SELECT DISTINCT id AS run_id, structural_config_hash AS input_hash, lifecycle_status FROM kb_runs WHERE structural_config_hash IS NOT NULL)
    SELECT DISTINCT input_hash FROM v a WHERE NOT (EXISTS (SELECT 1 FROM v b WHERE b.input_hash = a.input_hash AND b.lifecycle_status = 'superseded') AND NOT EXISTS (SELECT 1 FROM v b WHERE b.input_hash = a.input_hash AND b.lifecycle_status <> 'superseded'))"""
)
def referenced_attestations(spark: SparkSession, base: str) -> DataFrame:
    """Inputs still referred to if all superseded runs were pruned."""
    v = table(spark, base, "kb_runs").filter("structural_config_hash is not null").select(F.col("id").alias("run_id"), F.col("structural_config_hash").alias("input_hash"), "lifecycle_status").distinct()
    return store.referenced(v.select("input_hash").distinct(), v, v.filter("lifecycle_status = 'superseded'"))


@query(
    """SELECT CAST(user_id AS VARCHAR) AS run_id, arg_min(event_type, (ts, event_id)) AS index_name, arg_max(event_type, (ts, event_id)) AS lifecycle_status, min(ts) AS started_at FROM events GROUP BY user_id"""
)
def folded_runs(spark: SparkSession, base: str) -> DataFrame:
    """events as a log of runs: a user is a run, the event its state."""
    log = table(spark, base, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("index_name"), F.col("event_type").alias("state"), F.lit(None).cast("string").alias("verdict"), F.col("props").alias("metadata"), F.col("ts").alias("at"), F.col("event_id").alias("position"))
    return store.fold_runs(log).select("run_id", "index_name", "lifecycle_status", "started_at")


# --- search

PROBE = "(SELECT embedding FROM chunks WHERE chunk_id = (SELECT min(chunk_id) FROM chunks WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0) LIMIT 1)"
LIVE_CHUNKS = """(SELECT c.chunk_id, i.name AS index_name, c.source_id, c.embedding, d.locale FROM (SELECT DISTINCT chunk_id, run_id, document_id, source_id, embedding FROM chunks) c JOIN (SELECT DISTINCT name, live_run_id FROM kb_indexes WHERE live_run_id IS NOT NULL) i ON c.run_id = i.live_run_id
  JOIN (SELECT DISTINCT ON (id, run_id) id, run_id, locale FROM run_documents ORDER BY id, run_id, canonical_url) d ON d.id = c.document_id AND d.run_id = c.run_id
  WHERE len(c.embedding) = 64 AND len(list_filter(c.embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(c.embedding, lambda x: x <> 0)) > 0)"""
SCORED = f"(SELECT *, list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM {PROBE})) AS score FROM {LIVE_CHUNKS})"


def _probe(spark: SparkSession, base: str) -> list[float]:
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return table(spark, base, "chunks").filter((F.size("embedding") == 64) & usable).orderBy("chunk_id").select("embedding").first()[0]


def _live(spark: SparkSession, base: str) -> DataFrame:
    chunks = table(spark, base, "chunks").select("chunk_id", "run_id", "document_id", "source_id", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return search.live_chunks(chunks.filter((F.size("embedding") == 64) & finite), table(spark, base, "kb_indexes"), table(spark, base, "run_documents"))


@query(f"SELECT chunk_id, index_name, round(score, 4) AS score FROM {SCORED} ORDER BY score DESC, chunk_id LIMIT 10")
def live_search(spark: SparkSession, base: str) -> DataFrame:
    """The ten live chunks nearest to the first usable vector."""
    return search.top_k(_live(spark, base), _probe(spark, base)).select("chunk_id", "index_name", F.round("score", 4).alias("score"))


@query(f"SELECT chunk_id, index_name, round(score, 4) AS score FROM {SCORED} ORDER BY score DESC, chunk_id LIMIT 10")
def indexed_search(spark: SparkSession, base: str) -> DataFrame:
    """live_search() through an index of cells, of which those are read that can hold one of the ten."""
    indexed, centroids = vector_index.built(stored(_live(spark, base)), 64)
    return vector_index.top_k(stored(indexed), centroids, _probe(spark, base), exact=True).select("chunk_id", "index_name", F.round("score", 4).alias("score"))


@query(f"SELECT chunk_id, index_name, round(score, 4) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY index_name ORDER BY score DESC, chunk_id) AS rank FROM {SCORED}) WHERE rank <= 10")
def search_per_index(spark: SparkSession, base: str) -> DataFrame:
    return search.top_k_per_index(_live(spark, base), _probe(spark, base)).select("chunk_id", "index_name", F.round("score", 4).alias("score"), "rank")


@query(f"SELECT chunk_id, round(score, 4) AS score FROM {SCORED} WHERE locale = 'de' ORDER BY score DESC, chunk_id LIMIT 10")
def filtered_search(spark: SparkSession, base: str) -> DataFrame:
    return search.top_k(_live(spark, base).filter("locale = 'de'"), _probe(spark, base)).select("chunk_id", F.round("score", 4).alias("score"))


@query(f"SELECT chunk_id, round(score, 4) AS score FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY index_name ORDER BY score DESC, chunk_id) AS rank FROM {SCORED}) WHERE rank <= 10) ORDER BY score DESC, chunk_id LIMIT 10")
def merged_search(spark: SparkSession, base: str) -> DataFrame:
    return search.merged(search.top_k_per_index(_live(spark, base), _probe(spark, base))).select("chunk_id", F.round("score", 4).alias("score"))


@query(
    f"""SELECT chunk_id, round(score, 4) AS score FROM (SELECT DISTINCT c.chunk_id, list_cosine_similarity(c.embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM {PROBE})) AS score FROM chunks c
      WHERE c.run_id = (SELECT previous_live_run_id FROM kb_indexes ORDER BY name LIMIT 1) AND len(c.embedding) = 64 AND len(list_filter(c.embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(c.embedding, lambda x: x <> 0)) > 0)
    ORDER BY score DESC, chunk_id LIMIT 10"""
)
def run_search(spark: SparkSession, base: str) -> DataFrame:
    """The ten nearest chunks of one run that isn't live."""
    run = table(spark, base, "kb_indexes").orderBy("name").select("previous_live_run_id").first()[0]
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chunks = table(spark, base, "chunks").filter((F.col("run_id") == run) & (F.size("embedding") == 64) & finite).select("chunk_id", "embedding").distinct()
    return search.top_k(chunks, _probe(spark, base)).select("chunk_id", F.round("score", 4).alias("score"))


# --- audit events

@query("SELECT date_trunc('day', ts)::TIMESTAMP AS \"from\", date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS \"to\", event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_log_daily(spark: SparkSession, base: str) -> DataFrame:
    found = streaming.windowed_counts(table(spark, base, "events").withColumn("value", F.col("value").cast("decimal(18,6)")))
    return found.withColumn("total", F.round(F.col("total").cast("double"), 4))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) > 50")
def metadata_filter(spark: SparkSession, base: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, base, "events").filter(k > 50).select("event_id", k.alias("k"))


@query(
    """WITH marked AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    grouped AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM marked)
    SELECT user_id, min(ts) AS "from", max(ts) + INTERVAL 30 MINUTE AS "to", count(*) AS events FROM grouped GROUP BY user_id, s"""
)
def event_sessions(spark: SparkSession, base: str) -> DataFrame:
    return streaming.sessions(table(spark, base, "events"))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)
