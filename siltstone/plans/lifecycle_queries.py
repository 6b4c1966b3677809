"""Queries of evidence, lifecycle and the store itself, with their SQL."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import diff, pipeline, reuse, schema, store
from siltstone.operators.snapshots import canonical_address, canonical_source
from siltstone.plans.refresh_queries import LIVE, live_diff, live_sides
from siltstone.session import shared_folder, stored, table

_SQL: dict[str, str] = {}
_QUERIES: dict = {}


def query(sql: str | None = None):
    def keep(function):
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return keep


# --- what changed inside documents

EVIDENCE = (
    LIVE
    + r""", named AS (SELECT DISTINCT source_id, canonical_url FROM diff WHERE change_type = 'changed'),
ch AS (SELECT run_id, lower(trim(source_id, E' \t\n\r')) AS source_id, regexp_replace(trim(json_extract_string(metadata, '$.canonical_url'), E' \t\n\r'), '#.*$', '', 's') AS bare, chunk_index, content FROM (SELECT DISTINCT * FROM chunks)),
located AS (SELECT run_id, source_id, lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) || substr(bare, length(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)) + 1) AS canonical_url, chunk_index, content FROM ch),
sided AS (SELECT l.*, 'now' AS side FROM located l WHERE run_id IN (SELECT live_run_id FROM pointers) UNION ALL SELECT l.*, 'before' FROM located l WHERE run_id IN (SELECT previous_live_run_id FROM pointers)),
joined AS (SELECT side, source_id, canonical_url, string_agg(content, chr(10) ORDER BY chunk_index, content) AS text FROM sided s WHERE EXISTS (SELECT 1 FROM named n WHERE n.source_id = s.source_id AND n.canonical_url = s.canonical_url) GROUP BY ALL),
cut AS (SELECT side, source_id, canonical_url, list_filter(list_transform(string_split_regex(text, '\r\n|\n|\r'), lambda s: trim(s)), lambda s: s <> '') AS parts FROM joined),
lines AS (SELECT side, source_id, canonical_url, unnest(range(1, len(parts) + 1)) AS position, unnest(parts) AS segment FROM cut),
counted AS (SELECT *, row_number() OVER (PARTITION BY side, source_id, canonical_url, segment ORDER BY position) AS nth FROM lines),
own AS (SELECT c.*, row_number() OVER w AS n, coalesce(sum(length(segment)) OVER (PARTITION BY side, source_id, canonical_url ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM counted c
  WHERE nth > (SELECT count(*) FROM lines o WHERE o.side <> c.side AND o.source_id = c.source_id AND o.canonical_url = c.canonical_url AND o.segment = c.segment) WINDOW w AS (PARTITION BY side, source_id, canonical_url ORDER BY position)),
kept AS (SELECT side, source_id, canonical_url, count(*) FILTER (WHERE NOT (n <= 100 AND before < 20000)) AS omitted,
  string_agg(CASE WHEN length(segment) <= 20000 - before THEN segment ELSE substr(segment, 1, greatest(20000 - before - 1, 0)::INT) || '…' END, chr(10) ORDER BY n) FILTER (WHERE n <= 100 AND before < 20000) AS segments FROM own GROUP BY ALL),
evidence AS (SELECT n.source_id, n.canonical_url, coalesce(r.segments, '') AS removed_segments, coalesce(a.segments, '') AS added_segments, coalesce(r.omitted, 0) AS removed_omitted, coalesce(a.omitted, 0) AS added_omitted
  FROM named n LEFT JOIN kept r ON r.side = 'before' AND r.source_id = n.source_id AND r.canonical_url = n.canonical_url LEFT JOIN kept a ON a.side = 'now' AND a.source_id = n.source_id AND a.canonical_url = n.canonical_url)
"""
)


def _evidence(spark: SparkSession, base: str) -> DataFrame:
    """Lines added to and removed from the changed documents, by their chunks in the last two full deliveries."""
    rows = table(spark, base, "chunks").distinct()
    chunks = rows.withColumn("canonical_url", canonical_address(F.get_json_object("metadata", "$.canonical_url"))).withColumn("source_id", canonical_source(F.col("source_id")))
    pointers = table(spark, base, "kb_indexes").select("live_run_id", "previous_live_run_id").distinct()
    now, before = (chunks.join(pointers.select(F.col(c).alias("run_id")), "run_id", "left_semi") for c in ("live_run_id", "previous_live_run_id"))
    found = diff.content_changes(before, now, live_diff(spark, base).filter("change_type = 'changed'"))
    return found.withColumns({c: F.array_join(c, "\n") for c in ("removed_segments", "added_segments")})


@query(EVIDENCE + "SELECT * FROM evidence")
def content_changes(spark: SparkSession, base: str) -> DataFrame:
    return _evidence(spark, base)


@query(
    EVIDENCE
    + """SELECT c.source_id, c.canonical_url, length(e.removed_segments) AS removed, length(e.added_segments) AS added FROM cur c LEFT JOIN evidence e ON e.source_id = c.source_id AND e.canonical_url = c.canonical_url
    WHERE EXISTS (SELECT 1 FROM diff d WHERE d.change_type IN ('added', 'changed', 'moved') AND d.source_id = c.source_id AND d.canonical_url = c.canonical_url)"""
)
def documents_with_evidence(spark: SparkSession, base: str) -> DataFrame:
    """The documents a verifier is shown, with the size of what changed in them."""
    _, current = live_sides(spark, base)
    named = diff.covered(current, live_diff(spark, base)).select("source_id", "canonical_url")
    sizes = _evidence(spark, base).select("source_id", "canonical_url", F.length("removed_segments").alias("removed"), F.length("added_segments").alias("added"))
    return named.join(sizes, ["source_id", "canonical_url"], "left")


# --- vectors, old and new

@query(
    """WITH before AS (SELECT content_hash, min(chunk_id) AS giver FROM chunks c JOIN (SELECT DISTINCT previous_live_run_id FROM kb_indexes) i ON c.run_id = i.previous_live_run_id WHERE embedding IS NOT NULL GROUP BY ALL),
    given AS (SELECT content_hash, min(chunk_id) AS giver FROM chunks c JOIN (SELECT DISTINCT live_run_id FROM kb_indexes) i ON c.run_id = i.live_run_id WHERE embedding IS NOT NULL AND content_hash < '8' GROUP BY ALL)
    SELECT c.chunk_id, b.giver IS NOT NULL AND g.giver IS NULL AS embedding_reused, coalesce(g.giver, b.giver) AS giver
    FROM (SELECT DISTINCT chunk_id, run_id, content_hash FROM chunks) c JOIN (SELECT DISTINCT live_run_id FROM kb_indexes) i ON c.run_id = i.live_run_id LEFT JOIN before b ON b.content_hash = c.content_hash LEFT JOIN given g ON g.content_hash = c.content_hash"""
)
def vectors_old_and_new(spark: SparkSession, base: str) -> DataFrame:
    """Live chunks with vectors of the previous live run, those of hashes below 8 taken as embedded anew, which go first.
    A vector is told by the chunk that gave it."""
    chunks, pointers = table(spark, base, "chunks"), table(spark, base, "kb_indexes")
    of = lambda column: chunks.join(pointers.select(F.col(column).alias("run_id")).distinct(), "run_id", "left_semi")
    known = of("previous_live_run_id").filter("embedding is not null and content_hash is not null").groupBy("content_hash").agg(F.array(F.min("chunk_id")).alias("embedding"))
    fresh = of("live_run_id").filter("embedding is not null and content_hash < '8'").groupBy("content_hash").agg(F.array(F.min("chunk_id")).alias("embedding"))
    now = of("live_run_id").select("chunk_id", "run_id", "content_hash").distinct()
    return reuse.attached(now, known, fresh).select("chunk_id", "embedding_reused", F.get("embedding", F.lit(0)).alias("giver"))


# --- lifecycle

@query(
    """SELECT DISTINCT id, CASE WHEN lifecycle_status <> 'complete' THEN 'run is ' || lifecycle_status || ', not complete' WHEN coalesce(CAST(json_extract(metadata, '$.embeddings_disabled') AS BOOLEAN), false) THEN 'run was embedded without a provider'
      WHEN verification_verdict = 'pass' OR verification_verdict = 'caution' THEN NULL ELSE 'verdict is ' || coalesce(verification_verdict, 'None') END AS reason FROM kb_runs"""
)
def activation_reasons(spark: SparkSession, base: str) -> DataFrame:
    """Why a run can't be activated where caution is allowed; null where it can."""
    return table(spark, base, "kb_runs").select("id", store.activation_reason(F.col("lifecycle_status"), F.col("metadata"), F.col("verification_verdict"), True).alias("reason")).distinct()


@query(
    """SELECT DISTINCT r.id, CASE WHEN coalesce(CAST(json_extract(r.metadata, '$.auto_activate') AS BOOLEAN), false) AND r.started_at > f.first_at AND r.verification_verdict = 'pass' THEN 'activate' ELSE 'hold' END AS action
    FROM kb_runs r JOIN (SELECT index_name, min(started_at) AS first_at FROM kb_runs GROUP BY ALL) f ON f.index_name = r.index_name"""
)
def decided_actions(spark: SparkSession, base: str) -> DataFrame:
    """What would have been done with each run by itself; the first of an index is always held."""
    runs = table(spark, base, "kb_runs").select("id", "index_name", "metadata", "verification_verdict", "started_at").distinct()
    first = runs.groupBy("index_name").agg(F.min("started_at").alias("first_at"))
    enabled = F.coalesce(F.get_json_object("metadata", "$.auto_activate").cast("boolean"), F.lit(False))
    return runs.join(first, "index_name").select("id", store.action_column(enabled, F.col("started_at") == F.col("first_at"), F.lit("openai"), F.col("verification_verdict")).alias("action"))


@query(
    """WITH runs AS (SELECT id, any_value(index_name) AS index_name, any_value(lifecycle_status) AS lifecycle_status, any_value(coalesce(finished_at, started_at)) AS at FROM kb_runs GROUP BY id),
    gone AS (SELECT r.id, r.index_name FROM runs r JOIN (SELECT DISTINCT name, live_run_id, previous_live_run_id FROM kb_indexes) i ON r.index_name = i.name WHERE r.id IS DISTINCT FROM i.live_run_id AND r.id IS DISTINCT FROM i.previous_live_run_id
      AND r.lifecycle_status IN ('complete', 'superseded', 'rejected', 'error') AND r.at < TIMESTAMP '2023-12-15 00:00:00')
    SELECT g.index_name, count(DISTINCT g.id) AS runs, count(d.run_id) AS documents FROM gone g LEFT JOIN run_documents d ON d.run_id = g.id GROUP BY g.index_name"""
)
def pruned_rows(spark: SparkSession, base: str) -> DataFrame:
    """Runs and rows that pruning by age would free, by index."""
    gone = store.prune_candidates(table(spark, base, "kb_runs"), table(spark, base, "kb_indexes"), older_than=datetime(2023, 12, 15)).select(F.col("id").alias("run_id"), "index_name").distinct()
    rows = table(spark, base, "run_documents").groupBy("run_id").agg(F.count(F.lit(1)).alias("documents"))
    return gone.join(rows, "run_id", "left").groupBy("index_name").agg(F.count(F.lit(1)).alias("runs"), F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"))


@query("SELECT DISTINCT name, substr(sha256('index:' || name), 1, 16) AS lock_key FROM kb_indexes")
def lock_keys(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "kb_indexes").select("name", schema.lock_key_column(F.col("name")).alias("lock_key")).distinct()


@query("SELECT DISTINCT source_id, language_allowed IS NULL OR list_has_all(['de', 'en', 'fr', 'it', 'nl'], language_allowed) AS within FROM kb_sources")
def allowed_subsets(spark: SparkSession, base: str) -> DataFrame:
    """Whether a source allows only languages of a given list."""
    rest = F.array_except("language_allowed", F.lit(["de", "en", "fr", "it", "nl"]))
    return table(spark, base, "kb_sources").select("source_id", (F.col("language_allowed").isNull() | (F.size(rest) == 0)).alias("within")).distinct()


@query(
    """WITH items AS (SELECT DISTINCT source_id, canonical_url, external_id FROM run_documents),
    first AS (SELECT * FROM items QUALIFY canonical_url IS NULL OR row_number() OVER (PARTITION BY source_id, canonical_url ORDER BY external_id NULLS FIRST) = 1)
    SELECT i.source_id, i.discovered, u.uniq AS "unique", u.deduped FROM (SELECT source_id, count(*) AS discovered FROM items GROUP BY ALL) i
    JOIN (SELECT source_id, count(*) AS uniq, count(DISTINCT external_id) + count(*) FILTER (WHERE external_id IS NULL) AS deduped FROM first GROUP BY ALL) u ON u.source_id = i.source_id"""
)
def discovery_counts(spark: SparkSession, base: str) -> DataFrame:
    """Discovered, unique and deduplicated items of each source."""
    items = table(spark, base, "run_documents").select("source_id", "canonical_url", "external_id").distinct()
    return pipeline.funnel(items, ["source_id"], "external_id")


@query("SELECT id, index_name, lifecycle_status, json_extract_string(metadata, '$.embedding_fingerprint') AS embedding_fingerprint FROM (SELECT DISTINCT * FROM kb_runs WHERE id = (SELECT min(id) FROM kb_runs))")
def run_by_id(spark: SparkSession, base: str) -> DataFrame:
    runs = table(spark, base, "kb_runs").distinct()
    first = runs.agg(F.min("id").alias("id"))
    return runs.join(first, "id", "left_semi").select("id", "index_name", "lifecycle_status", F.get_json_object("metadata", "$.embedding_fingerprint").alias("embedding_fingerprint"))


@query(
    """SELECT i.name AS index_name, d.locale, count(*) AS chunks FROM (SELECT DISTINCT * FROM chunks) c JOIN (SELECT DISTINCT name, live_run_id FROM kb_indexes WHERE live_run_id IS NOT NULL) i ON c.run_id = i.live_run_id
    JOIN (SELECT id, run_id, CASE WHEN count(DISTINCT coalesce(locale, '')) = 1 THEN any_value(locale) END AS locale FROM run_documents GROUP BY ALL) d ON d.id = c.document_id AND d.run_id = c.run_id
    WHERE len(c.embedding) = 64 AND len(list_filter(c.embedding, lambda x: x IS NULL)) = 0 GROUP BY ALL"""
)
def live_view(spark: SparkSession, base: str) -> DataFrame:
    """The view that clients read, asked by SQL: chunks of live runs with vectors of one size, by index and locale."""
    documents = table(spark, base, "run_documents").groupBy("id", "run_id").agg(
        F.when(F.count_distinct(F.coalesce("locale", F.lit(""))) == 1, F.max("locale")).alias("locale"), F.max("canonical_url").alias("canonical_url"), F.max("title").alias("title")
    )
    name = f"live_{uuid.uuid4().hex}"
    schema.register_live_view(spark, table(spark, base, "chunks"), table(spark, base, "kb_indexes"), documents, name, 64)
    return spark.sql(f"SELECT index_name, locale, count(*) AS chunks FROM {name} GROUP BY index_name, locale")


# --- the store, written and read back

def _store(spark: SparkSession) -> store.Store:
    return store.Store(spark, f"{shared_folder(spark)}/siltstone-store-{uuid.uuid4().hex}")


@query("SELECT DISTINCT d.run_id, d.id, d.title, d.normalized_content_hash FROM run_documents d WHERE d.run_id IN (SELECT live_run_id FROM kb_indexes)")
def stored_documents(spark: SparkSession, base: str) -> DataFrame:
    """The documents of the live runs, written run by run into a store and read back."""
    kept = _store(spark)
    rows = table(spark, base, "run_documents").select("run_id", "id", "title", "normalized_content_hash").distinct()
    for r in table(spark, base, "kb_indexes").filter("live_run_id is not null").select("live_run_id").distinct().toLocalIterator():  # one for each index
        mine = rows.filter(F.col("run_id") == r[0]).drop("run_id")
        kept.persist(r[0], {"documents": mine.limit(0), "sources": mine.limit(0)})
        kept.persist(r[0], {"documents": mine})
    found = stored(kept.read("documents").select("run_id", "id", "title", "normalized_content_hash"))
    kept.folder.delete()
    return found


@query("SELECT DISTINCT id AS run_id, index_name, CASE WHEN lifecycle_status = 'activated' THEN 'superseded' ELSE lifecycle_status END AS lifecycle_status, verification_verdict FROM kb_runs")
def stored_runs(spark: SparkSession, base: str) -> DataFrame:
    """The runs, logged event by event; activated ones are superseded by a later event."""
    kept = _store(spark)
    for r in table(spark, base, "kb_runs").select("id", "index_name", "lifecycle_status", "verification_verdict").distinct().toLocalIterator():  # the log of runs is written one by one
        kept.record(r["id"], r["index_name"], "created", "created", metadata={"a": 1})
        kept.record(r["id"], r["index_name"], r["lifecycle_status"], "moved", r["verification_verdict"], {"b": 2})
        if r["lifecycle_status"] == "activated":
            kept.record(r["id"], r["index_name"], "superseded", "superseded")
    found = stored(kept.runs().select("run_id", "index_name", "lifecycle_status", "verification_verdict"))
    kept.folder.delete()
    return found


@query(
    """WITH v AS (SELECT DISTINCT id AS run_id, structural_config_hash AS input_hash, lifecycle_status, verification_verdict AS verdict FROM kb_runs WHERE structural_config_hash IS NOT NULL AND verification_verdict IS NOT NULL)
    SELECT DISTINCT input_hash, 'local' AS attestor FROM v a WHERE EXISTS (SELECT 1 FROM v b WHERE b.input_hash = a.input_hash AND b.lifecycle_status <> 'superseded')"""
)
def pruned_attestations(spark: SparkSession, base: str) -> DataFrame:
    """Results that are left in a store once its superseded runs were pruned."""
    kept = _store(spark)
    runs = table(spark, base, "kb_runs").filter("structural_config_hash is not null and verification_verdict is not null").select("id", "index_name", "structural_config_hash", "lifecycle_status", "verification_verdict").distinct()
    for r in runs.toLocalIterator():  # a store takes runs one by one
        kept.record(r["id"], r["index_name"], "created", "created")
        kept.record(r["id"], r["index_name"], r["lifecycle_status"], "moved", r["verification_verdict"])
        kept.point(r["index_name"], None, None)
        kept.save_verification(r["id"], "pass", {"verdict": r["verification_verdict"], "source": "provider", "input_hash": r["structural_config_hash"]}, [])
        kept.attest(r["structural_config_hash"], "local", {"verdict": r["verification_verdict"]})
    kept.prune(statuses=["superseded"])
    found = stored(kept.attestations().select("input_hash", "attestor"))
    kept.folder.delete()
    return found


@query("SELECT name, live_run_id, previous_live_run_id FROM (SELECT DISTINCT name, live_run_id, previous_live_run_id FROM kb_indexes)")
def stored_pointers(spark: SparkSession, base: str) -> DataFrame:
    """The pointers, moved from the previous live run to the live one."""
    kept = _store(spark)
    for r in table(spark, base, "kb_indexes").select("name", "live_run_id", "previous_live_run_id").distinct().toLocalIterator():  # one for each index
        kept.point(r["name"], r["previous_live_run_id"], None)
        kept.point(r["name"], r["live_run_id"], r["previous_live_run_id"])
    found = stored(kept.pointers())
    kept.folder.delete()
    return found


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)
