from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.operators import dedupe, diff, gate, reuse, search
from siltstone.operators.language_choice import annotated

DOCS = "source_id string, canonical_url string, title string, locale string, normalized_content_hash string"


def docs(spark, *rows):
    return spark.createDataFrame([(s, u, f"t{u}", "en", h) for s, u, h in rows], DOCS)


def test_run_diff_and_summary(spark):
    prev = docs(spark, ("s", "/same", "1"), ("s", "/changed", "2"), ("s", "/old", "3"), ("s", "/gone", "4"), ("s", "/null", None))
    cur = docs(spark, ("s", "/same", "1"), ("s", "/changed", "9"), ("t", "/new", "3"), ("s", "/fresh", "5"), ("s", "/null", None))
    found = diff.run_diff(prev, cur)
    rows = {(r["change_type"], r["source_id"], r["canonical_url"], r["previous_url"]) for r in found.collect()}
    assert rows == {("changed", "s", "/changed", None), ("added", "t", "/new", None), ("added", "s", "/fresh", None), ("removed", "s", "/old", None), ("removed", "s", "/gone", None), ("moved", "t", "/new", "/old")}
    assert diff.diff_summary(found, prev, cur).first().asDict() == {"previous_count": 5, "current_count": 5, "added_count": 2, "removed_count": 2, "changed_count": 1, "moved_count": 1}
    assert {r["canonical_url"] for r in diff.covered(cur, found).collect()} == {"/changed", "/new", "/fresh"}
    assert {(r["change_type"], r["canonical_url"]) for r in diff.uncovered(found, cur).collect()} == {("removed", "/old"), ("removed", "/gone")}
    assert diff.first_changes(found, 2).select("hidden").first()[0] == 4
    sizes = {r["canonical_url"]: len(r["entries"]) for r in diff.annotated(cur, found).collect()}
    assert sizes == {"/same": 0, "/changed": 1, "/new": 2, "/fresh": 1, "/null": 0}


def test_first_run_adds_everything(spark):
    cur = docs(spark, ("s", "/a", "1"), ("s", "/b", "1"))
    assert [r["change_type"] for r in diff.run_diff(cur.limit(0), cur).collect()] == ["added", "added"]


CHUNKS = "source_id string, canonical_url string, chunk_index int, content string"


def test_content_changes_keep_order_and_bounds(spark):
    before = spark.createDataFrame([("s", "/a", 0, "x\ny\nx"), ("s", "/a", 1, "z")], CHUNKS)
    now = spark.createDataFrame([("s", "/a", 0, "x\nq\nq\n  \nz")], CHUNKS)
    changed = docs(spark, ("s", "/a", "1"))
    row = diff.content_changes(before, now, changed).first()
    assert (row["removed_segments"], row["added_segments"], row["removed_omitted"]) == (["y", "x"], ["q", "q"], 0)
    tight = diff.content_changes(before, now, changed, most=1, chars=20_000).first()
    assert (tight["removed_segments"], tight["removed_omitted"], tight["added_omitted"]) == (["y"], 1, 1)
    long = spark.createDataFrame([("s", "/a", 0, "a" * 50 + "\n" + "b" * 50)], CHUNKS)
    cut = diff.content_changes(before.limit(0), long, changed, chars=60).first()["added_segments"]
    assert cut == ["a" * 50, "b" * 9 + "…"] and sum(map(len, cut)) == 60


def test_best_of_group(spark):
    rows = [("1", "/long/en/page", "h"), ("1", "/x", "h"), (None, "/a", "h"), (None, "/b", None), ("2", "/c", None)]
    frame = spark.createDataFrame(rows, "external_id string, canonical_url string, normalized_content_hash string")
    urls = lambda df: sorted(r["canonical_url"] for r in df.collect())
    assert urls(dedupe.deduped(frame, prefer=["/en/"])) == ["/a", "/b", "/c", "/long/en/page"]
    assert urls(dedupe.deduped(frame)) == ["/a", "/b", "/c", "/x"]
    assert urls(dedupe.deduped(frame, by_content=True)) == ["/a", "/b", "/c"]
    assert urls(dedupe.first_by_url(frame.unionByName(frame).withColumn("n", F.monotonically_increasing_id()), "n")) == ["/a", "/b", "/c", "/long/en/page", "/x"]


def test_reuse(spark):
    t = datetime(2024, 1, 1)
    runs = spark.createDataFrame([(f"r{i}", "i", "complete" if i != 5 else "error", 2, '{"embedding_fingerprint": "f"}', t + timedelta(days=i)) for i in range(8)], "id string, index_name string, lifecycle_status string, embedding_dimensions int, metadata string, started_at timestamp")
    usable = reuse.candidate_runs(runs, "i", 2, "f")
    assert sorted(r["id"] for r in usable.collect()) == ["r2", "r3", "r4", "r6", "r7"]
    chunks = spark.createDataFrame([("r7", "a", [1.0, 0.0], 1), ("r2", "a", [0.0, 1.0], 2), ("r0", "b", [0.0, 1.0], 3), ("r6", "c", None, 4)], "run_id string, content_hash string, embedding array<float>, chunk_id long")
    old = reuse.reusable_vectors(chunks, usable)
    assert [(r["content_hash"], r["run_id"], r["embedding"]) for r in old.collect()] == [("a", "r7", [1.0, 0.0])]
    new = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "b")], "source_id string, content_hash string")
    assert [r[0] for r in reuse.missing_hashes(new, old).collect()] == ["b"]
    counts = reuse.reuse_counts(new, old, ["source_id"]).first()
    assert (counts["chunk_count"], counts["reused_count"], counts["embedded_count"], counts["request_count"]) == (3, 1, 2, 1)
    fresh = spark.createDataFrame([("b", [0.5, 0.5])], "content_hash string, embedding array<float>")
    got = {(r["content_hash"], r["embedding_reused"], tuple(r["embedding"])) for r in reuse.attached(new, old, fresh).collect()}
    assert got == {("a", True, (1.0, 0.0)), ("b", False, (0.5, 0.5))}


COUNTS = "document_count long, error_count long, skipped_count long, empty_or_short_document_count long, previous_count long, removed_count long, changed_count long"
LIMITS = gate.Thresholds(5, 0.1, 0.2, 0.1, 0.1)


@pytest.mark.parametrize(
    "row, checks, verdict",
    [
        ((10, 0, 0, 0, 10, 0, 0), [], "pass"),
        ((0, 0, 0, 0, 0, 0, 0), ["zero_documents"], "fail"),
        ((10, 0, 0, 0, 10, 1, 2), [], "pass"),
        ((10, 0, 0, 0, 100, 6, 21), ["max_removed_absolute", "max_changed_percentage"], "caution"),
        ((10, 0, 0, 0, 10, 2, 0), ["max_removed_percentage"], "caution"),
        ((10, 0, 0, 0, 0, 0, 9), [], "pass"),
        ((8, 2, 0, 2, 10, 0, 0), ["max_item_failure_percentage", "max_empty_or_short_document_percentage"], "caution"),
    ],
)
def test_gate(spark, row, checks, verdict):
    found = gate.gated(spark.createDataFrame([row], COUNTS), LIMITS).first()
    assert ([f["check"] for f in found["findings"]], found["verdict"]) == (checks, verdict)


def test_gate_without_thresholds(spark):
    assert gate.gated(spark.createDataFrame([(1, 99, 0, 99, 1, 99, 99)], COUNTS), gate.Thresholds()).first()["verdict"] == "pass"


def test_verdicts(spark):
    frame = spark.createDataFrame([("i", 1, "pass", "ok"), ("i", 2, "caution", "x"), ("i", 3, "caution", "x"), ("j", 1, "pass", " ")], "k string, batch int, verdict string, reasoning string")
    assert {(r["k"], r["pass_count"], r["caution_count"], r["fail_count"], r["verdict"]) for r in gate.batch_summary(frame, ["k"]).collect()} == {("i", 1, 2, 0, "caution"), ("j", 1, 0, 0, "pass")}
    assert gate.reason_groups(frame, ["k"]).first()["batches"] == [2, 3]
    assert gate.pass_groups(frame, ["k"]).count() == 1
    assert (gate.final_verdict("pass", None), gate.final_verdict("fail", "pass"), gate.final_verdict("pass", "pass")) == ("caution", "fail", "pass")


def test_search(spark):
    rows = [(1, "a", [1.0, 0.0]), (2, "a", [1.0, 0.0]), (3, "a", [0.0, 1.0]), (4, "b", [1.0, 1.0]), (5, "b", [0.0, 0.0]), (6, "b", None), (7, "b", [1.0])]
    frame = spark.createDataFrame(rows, "chunk_id long, index_name string, embedding array<float>")
    assert [r["chunk_id"] for r in search.top_k(frame, [1.0, 0.0], 3).collect()] == [1, 2, 4]
    best = search.top_k_per_index(frame, [1.0, 0.0], 1)
    assert {(r["index_name"], r["chunk_id"]) for r in best.collect()} == {("a", 1), ("b", 4)}
    assert [r["chunk_id"] for r in search.merged(best, 1).collect()] == [1]
    with pytest.raises(search.IncompatibleRun):
        search.require_compatible({"embedding_dimensions": 2, "embedding_fingerprint": "x"}, 2, "y")


@pytest.mark.parametrize(
    "html, text, config, want",
    [
        ("de-AT", "the text is here", {}, ("de", "html")),
        (None, "Der Text ist nicht für die anderen", {}, ("de", "detected")),
        ("de", "the text", {"mode": "detect", "allowed": ["en", "nl"]}, ("en", "detected")),
        ("de", "x", {"allowed": ["en"]}, ("en", "configured")),
        (None, "zz yy", {"fallback": "nl"}, ("nl", "fallback")),
        (None, "", {}, (None, "unknown")),
        ("en", "x", {"mode": "configured", "locale": "fr_FR"}, ("fr", "configured")),
    ],
)
def test_language_precedence(spark, html, text, config, want):
    frame = spark.createDataFrame([(html, text)], "html_locale string, normalized_content string")
    row = annotated(frame, **config).first()
    assert (row["locale"], row["language_source"]) == want
    assert (row["language_confidence"] is None) == (want[1] in ("fallback", "unknown"))
