"""Refresh of an index: from sources to an activated or held run."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import dedupe, diff, embedding, gate, language_choice, pipeline, report, reuse, schema, search, vector_index
from siltstone.operators.store import Store, auto_action
from siltstone.operators.verification import MAX_PROMPT_TOKENS, Verification, prompt_stream
from siltstone.session import stored
from siltstone.sources import registry


@dataclass
class Refresh:
    """What a refresh needs from outside: transports of sources, embedders by index, verifier and notices."""

    spark: SparkSession
    store: Store
    transports: dict = field(default_factory=dict)
    embedders: dict[str, embedding.Embedder] = field(default_factory=dict)
    verification: Verification = field(default_factory=lambda: Verification(None))
    post: Callable[[str, str], int] | None = None
    #: Who results are put down for, and whose results of other stores are taken over, in their order.
    attestor: str = "local"
    trusted: list[str] = field(default_factory=list)
    config_hash: str | None = None

    @contextmanager
    def timed(self, timings: dict[str, float], name: str):
        began = time.monotonic()
        yield
        timings[name] = (time.monotonic() - began) * 1000

    def source_documents(self, source: dict) -> tuple[DataFrame, DataFrame]:
        """(documents, counts) of a source: keep-first by address, extraction, best of group, counts."""
        items = registry.items(self.spark, source, self.transports)
        for name in ("title", "external_id"):
            if name not in items.columns:
                items = items.withColumn(name, F.lit(None).cast("string"))
        if "discovered" not in items.columns:
            items = items.withColumn("discovered", F.monotonically_increasing_id())
        have = "outcome" in items.columns
        fetched = items.filter("outcome = 'fetched'") if have else items
        kept = dedupe.first_by_url(fetched.select(F.lit(source["id"]).alias("source_id"), "canonical_url", "external_id", "title", "content_type", "body", "discovered"), "discovered").drop("discovered")
        outcomes = stored(pipeline.documents(kept, registry.extraction_options(source)).drop("body"))
        found = outcomes.filter("outcome = 'document'")
        unique = dedupe.deduped(found, bool(source.get("dedupe_content")), source.get("dedupe_prefer_url_substrings"))
        failures = items.filter("outcome <> 'fetched'").select(F.lit(source["id"]).alias("source_id"), "outcome", F.lit(False).alias("empty_or_short_document")) if have else None
        counted = unique.select("source_id", "outcome", "empty_or_short_document").unionByName(outcomes.filter("outcome <> 'document'").select("source_id", "outcome", "empty_or_short_document"))
        counts = pipeline.source_counts(counted.unionByName(failures) if failures is not None else counted, ["source_id"])
        docs = unique.select("source_id", "canonical_url", "external_id", F.col("doc_title").alias("title"), "html_locale", "normalized_content", "normalized_content_hash", "raw_content_hash", F.col("new_blocks").alias("blocks"))
        config = source.get("language") or {}
        docs = language_choice.annotated(docs, mode=config.get("mode", "auto"), locale=config.get("locale"), allowed=config.get("allowed"), fallback=config.get("fallback"))
        return docs, counts

    def run_index(self, index: dict, limits: gate.Thresholds | None = None) -> dict:
        """Refresh one index under its lock; a failure leaves the run in error and the live run alone."""
        name, store = index["name"], self.store
        config = index.get("embedding") or {"provider": "noop", "embedding_dimensions": 64}
        mark = embedding.fingerprint(config | {"dimensions": config["embedding_dimensions"]})
        noop = config.get("provider", "noop") == "noop"
        with store.lock(name) as check:
            run_id = store.create_run(name, {"embedding_fingerprint": mark, "embeddings_disabled": noop, "structural_config_hash": self.config_hash})
            try:
                return self._run(index, run_id, config, mark, noop, limits or gate.Thresholds(), check)
            except Exception as problem:
                store.record(run_id, name, "error", "failed", metadata={"error": f"{type(problem).__name__}: {problem}"[:1024]})
                raise

    def _run(self, index, run_id, config, mark, noop, limits, check):
        name, store, size, timings = index["name"], self.store, config["embedding_dimensions"], {}
        store.record(run_id, name, "crawling", "crawling")
        with self.timed(timings, "crawl"):
            parts = [self.source_documents(s) for s in index["sources"]]
            docs, counts = parts[0]
            for more, own in parts[1:]:
                docs, counts = docs.unionByName(more), counts.unionByName(own)
            docs = stored(docs.withColumn("id", F.sha2(F.concat_ws("\u0000", F.lit(run_id), "source_id", "canonical_url"), 256)))
            counts = stored(counts)
        store.record(run_id, name, "embedding", "embedding")
        with self.timed(timings, "chunk"):
            packed = stored(pipeline.chunks(docs.select(F.col("id").alias("document_id"), "source_id", "canonical_url", "title", "locale", "blocks"), (index.get("chunking") or {}).get("max_tokens")))
        with self.timed(timings, "reuse"):
            old = stored(self.reusable(name, mark, size, packed))
        with self.timed(timings, "embed"):
            missing = reuse.missing_hashes(packed, old).join(packed.select("content_hash", "content"), "content_hash")
            provider = self.embedders.get(name) or embedding.NoEmbedder(size)
            fresh = stored(embedding.embedded(missing, provider, size=config.get("max_batch_size", embedding.MAX_BATCH), delay=config.get("inter_batch_delay_ms", 0) / 1000, **registry.retry_options(config, "")))
            ready = reuse.attached(packed, old, fresh).withColumn("chunk_id", F.xxhash64("document_id", "chunk_index"))
            requests = fresh.count()
        check()
        with self.timed(timings, "persist"):
            twice = schema.duplicate_keys(docs.withColumn("run_id", F.lit(run_id))).first()
            if twice:
                raise ValueError(f"{twice['source_id']} lists {twice['canonical_url']} {twice['n']} times")
            tables = {"documents": schema.conforms(docs.withColumn("metadata", F.to_json(F.struct("html_locale", F.size("blocks").alias("blocks")))), "documents"), "sources": counts}
            if not noop:
                ready = stored(ready)
                ready, tables["centroids"] = vector_index.built(ready, size)
            store.persist(run_id, tables | {"chunks": ready})
        live = store.pointer(name)["live_run_id"]
        current = store.read("documents", run_id)
        previous = store.read("documents", live) if live else current.limit(0)
        changes = stored(diff.run_diff(previous, current))
        store.persist(run_id, {"diffs": changes})
        summary = diff.diff_summary(changes, previous, current).first().asDict()
        totals = counts.agg(*[F.sum(c).alias(c) for c in ("document_count", "error_count", "skipped_count", "empty_or_short_document_count")]).first().asDict()
        row = self.spark.createDataFrame([{k: int(v or 0) for k, v in (totals | summary).items()}])
        gated = gate.gated(row, limits).first()
        store.record(run_id, name, "verifying", "verifying", metadata={"findings": [f.asDict() for f in gated["findings"]]})
        with self.timed(timings, "verify"):
            result = self.verify(name, changes, summary, gated, store.read("chunks", live) if live else None, store.read("chunks", run_id))
        findings = [f.asDict() for f in gated["findings"]]
        # the run refers to the result before the result is put down, so that pruning never finds it without a run
        store.save_verification(run_id, gated["verdict"], result, findings, self.attestor)
        if result.get("input_hash"):
            store.attest(result["input_hash"], self.attestor, result["llm"])
        check()
        action = auto_action(bool(index.get("auto_activate")), live is None, "noop" if noop else config["provider"], result["verdict"])
        store.record(run_id, name, "complete", "complete", verdict=result["verdict"], metadata={"requests": requests})
        if action == "activate":
            store.activate(run_id)
        shown = diff.first_changes(changes)
        lines = [r.asDict() for r in shown.collect()]  # 50 rows at most
        run = {"index_name": name, "run_id": run_id, "verdict": result["verdict"], "action": action, "diff": summary, "findings": findings, "chunk_count": store.read("chunks", run_id).count(), "timings": timings, "requests": requests, "reasoning": (result["llm"] or {}).get("reasoning")} | totals
        sources = [r.asDict() for r in counts.toLocalIterator()]
        hidden = lines[0]["hidden"] if lines else 0
        run["report"] = report.full_report(run, sources, lines, hidden)
        store.save_report(run_id, report.summary_line(run), run["report"])
        run["notice"] = report.notify(self.post, index.get("webhook_url"), report.message(run, sources, lines, hidden))
        return run

    def reusable(self, index: str, mark: str, size: int, packed: DataFrame) -> DataFrame:
        """The vectors of the newest runs that chunks of packed can take over."""
        runs = self.store.runs().withColumnRenamed("run_id", "id").withColumn("embedding_dimensions", F.lit(size))
        candidates = reuse.candidate_runs(runs, index, size, mark)
        if candidates.isEmpty():
            return self.spark.createDataFrame([], "index_name string, content_hash string, embedding array<float>, run_id string")
        return reuse.reusable_vectors(self.store.read("chunks"), candidates, packed)

    def verify(self, name: str, changes: DataFrame, summary: dict, gated, before: DataFrame | None, chunks: DataFrame) -> dict:
        """The verifier's result over the documents that the difference names, with their entries and what changed in
        them, and the entries that no document stands for. Both are written once and streamed batch by batch."""
        if self.verification.complete is None:
            return self.verification.run({}, [], gated["verdict"])
        keys = ["source_id", "canonical_url"]
        named = chunks.join(diff.current_keys(changes), keys, "left_semi")
        texts = named.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("chunk_index", "content_hash", "content"))).alias("chunks"))
        evidence = diff.content_changes(before if before is not None else chunks.limit(0), chunks, changes.filter("change_type = 'changed'"))
        evidence = evidence.select(*keys, F.struct(*[c for c in evidence.columns if c not in keys]).alias("content_changes"))
        documents = stored(diff.annotated(texts, changes).join(evidence, keys, "left")).orderBy("canonical_url", "source_id")
        rank = F.array_position(F.lit(list(diff.CLASSES)), F.col("change_type"))
        rest = stored(diff.uncovered(changes, texts).withColumn("rank", rank)).orderBy("rank", "canonical_url", "source_id", "previous_url")
        kept = {"changed": ("previous_hash", "current_hash"), "moved": ("previous_url",)}

        def entry(r: dict) -> dict:
            return {"classification": r["change_type"]} | {k: r[k] for k in kept.get(r["change_type"], ())}

        def of_documents():
            for r in documents.toLocalIterator():
                row = r.asDict(recursive=True)
                found = {"source_id": row["source_id"], "canonical_url": row["canonical_url"], "chunks": row["chunks"], "diff_entries": [entry(e) for e in row["entries"]]}
                yield found | ({"content_changes": row["content_changes"]} if row["content_changes"] else {})

        def of_entries():
            for r in rest.toLocalIterator():
                yield r["change_type"], {k: v for k, v in r.asDict().items() if k not in ("change_type", "rank") and v is not None}

        shown = {"summary": summary, "totals": {c: summary[f"{c}_count"] for c in diff.CLASSES}}
        base = {"index_name": name, "gate": {"verdict": gated["verdict"], "findings": [f.asDict() for f in gated["findings"]]}, "diff": shown}
        settings = self.verification.settings
        prompts = prompt_stream(base, of_documents, of_entries, settings.get("max_prompt_tokens", MAX_PROMPT_TOKENS))

        def attested(attestors: list[str], other):
            def look(key: str) -> dict | None:
                held = self.store.attested(key, attestors)
                return held[1] if held else other(key)

            return look

        verifier = replace(self.verification, trusted=attested(self.trusted, self.verification.trusted), saved=attested([self.attestor], self.verification.saved))
        return verifier.run_prompts(prompts, gated["verdict"])

    def run_all(self, indexes: list[dict], limits: gate.Thresholds | None = None, retention_days: float | None = None) -> list[dict]:
        """Orphans first, then each index by itself; retention only if none failed."""
        from datetime import timedelta

        self.store.reconcile()
        results = []
        for index in indexes:
            try:
                results.append(self.run_index(index, limits))
            except Exception as problem:  # noqa: BLE001 - one index must not stop the others
                results.append({"index_name": index["name"], "error": f"{type(problem).__name__}: {problem}"})
        if retention_days and not any("error" in r for r in results):
            self.store.prune(older_than=self.store.clock() - timedelta(days=retention_days))
        return results

    def search(self, index: dict, query: str, k: int = search.DEFAULT_LIMIT, probes: int | None = None, exact: bool = False) -> DataFrame:
        """The k chunks of the live run nearest to a query, among those of the nearest cells, or of all that can hold one
        (exact); the run's space is checked before the query is embedded."""
        config = index["embedding"]
        live = self.store.pointer(index["name"])["live_run_id"]
        if live is None:
            raise search.IncompatibleRun(f"{index['name']} has no live run")
        import json

        run = self.store.require(live)
        mark = embedding.fingerprint(config | {"dimensions": config["embedding_dimensions"]})
        stored_mark = json.loads(run["metadata"] or "{}").get("embedding_fingerprint")
        search.require_compatible({"id": live, "embedding_dimensions": config["embedding_dimensions"], "embedding_fingerprint": stored_mark}, config["embedding_dimensions"], mark)
        vector = self.embedders[index["name"]]([query])[0]
        chunks = self.store.read("chunks", live).withColumn("index_name", F.lit(index["name"]))
        if "centroids" not in self.store.committed(live):
            return search.top_k(chunks, vector, k)
        return vector_index.top_k(chunks, self.store.read("centroids", live), vector, k, probes, exact)
