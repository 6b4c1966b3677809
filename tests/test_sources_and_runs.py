import json
import sys
from datetime import datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from siltstone import cli
from siltstone.operators.embedding import HashEmbedder, HttpEmbedder, NoEmbedder, embedded, fingerprint
from siltstone.operators.gate import Thresholds
from siltstone.operators.refresh import Refresh
from siltstone.operators.store import Store
from siltstone.operators.verification import Verification
from siltstone.sources import files, registry, service_desk, web
from siltstone.sources.retry import RequestFailed
from siltstone.streaming import refresh as streaming

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def urlset(*pages):
    return "<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>" + "".join(f"<url><loc> {p} </loc></url>" for p in pages) + "</urlset>"


def index(*maps):
    return "<sitemapindex xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>" + "".join(f"<sitemap><loc>{m}</loc></sitemap>" for m in maps) + "</sitemapindex>"


SITE = {
    "https://a/map": (200, {}, index("https://a/one", "https://b/other", "https://a/map")),
    "https://a/one": (200, {}, urlset("https://a/p1", "https://a/p2", "https://a/p1", "https://a/deny/p")),
    "https://a/p1": (200, {"Content-Type": "text/html"}, "<h1>One</h1><p>First page text.</p><a href='/p2#x'>n</a><a href='https://c/'>x</a>"),
    "https://a/p2": (200, {}, "<h1>Two</h1><p>Second page text.</p><a href='/p1'>p</a><a href='/gone'>g</a><a href='/bad'>b</a>"),
    "https://a/gone": (404, {}, ""),
    "https://a/bad": (500, {}, ""),
}


def fetch(url):
    return SITE.get(url, (404, {}, ""))


def test_sitemaps(spark):
    found = web.discover_sitemaps(spark, ["https://a/map"], fetch, prefixes=["https://a/"], denied_prefixes=["https://a/deny/"], source_id="s")
    assert sorted(r["canonical_url"] for r in found.collect()) == ["https://a/p1", "https://a/p2"]
    with pytest.raises(ValueError):
        web.discover_sitemaps(spark, [], fetch)
    with pytest.raises(RequestFailed):
        web.discover_sitemaps(spark, ["https://a/nothing"], fetch)


def test_fetch_outcomes(spark):
    urls = spark.createDataFrame([(u,) for u in ("https://a/p1", "https://a/gone", "https://a/bad")], "canonical_url string")
    got = {r["canonical_url"][10:]: (r["outcome"], r["category"]) for r in web.fetched(urls, fetch, "s", attempts=1).collect()}
    assert got == {"p1": ("fetched", None), "gone": ("skipped", "not-found"), "bad": ("error", "fault")}


def test_fetches_of_a_host_are_spaced(spark):
    urls = spark.createDataFrame([(f"https://a/p{i % 2 + 1}",) for i in range(4)], "canonical_url string")
    began = datetime.now()
    web.fetched(urls, fetch, "s", delay=0.2, attempts=1).count()
    web.fetched(urls, fetch, "s", delay=0.2, attempts=1).collect()
    assert (datetime.now() - began).total_seconds() >= 0.6


def test_crawl(spark):
    got = web.crawl(spark, ["https://a/p1"], fetch, prefixes=["https://a/"], requeues=1, source_id="s")
    assert {(r["canonical_url"][10:], r["outcome"]) for r in got.collect()} == {("p1", "fetched"), ("p2", "fetched"), ("gone", "skipped"), ("bad", "error")}
    assert web.crawl(spark, ["https://a/p1"], fetch, prefixes=["https://a/"], max_pages=2).count() == 2
    assert web.crawl(spark, ["https://z/"], fetch, prefixes=["https://a/"]).count() == 0


PORTAL = '<script type="application/json">{"workspaceId": "w", "projectId": 1, "categories": [{"id": 5}]}</script>'


def get(url):
    if "/categories/" in url:
        start = int(url.split("start=")[1].split("&")[0])
        return 200, {"values": [{"id": 1}, {"id": 2}][start : start + 1]}
    number = url.rsplit("/", 1)[1]
    bodies = {"1": "<p>one</p><a href='/article/3'>x</a>", "2": " ", "3": "<p>three</p>"}
    return (200, {"title": f"t{number}", "body": bodies[number]}) if number in bodies else (404, {})


def test_service_desk(spark):
    assert service_desk.portal_context(PORTAL)["project"] == 1
    with pytest.raises(service_desk.PortalError):
        service_desk.portal_context("<p>x")
    got = service_desk.discover(spark, get, "https://d", ["5"], "s", page_size=1)
    assert {(r["external_id"], r["outcome"]) for r in got.collect()} == {("1", "fetched"), ("2", "error"), ("3", "fetched")}
    none = service_desk.discover(spark, lambda u: get(u) if "/categories/" in u else (404, {}), "https://d", ["5"], page_size=1).collect()
    assert [r["category"] for r in none] == ["unavailable"]


def test_service_desk_of_a_portal_page(spark):
    page = lambda url: (200, {}, PORTAL)
    bodies = lambda url: (200, {"title": "t", "body": "<p>x</p><a href='https://d/wiki/x/AbC'>short</a>"}) if url.endswith("/1") else get(url)
    head = lambda shim: (302, {"Location": "/wiki/spaces/K/pages/3/t"})
    source = {"id": "s", "type": "jira-service-management", "url": "https://d", "api_page_limit": 1}
    got = registry.items(spark, source, {"get": bodies, "fetch": page, "head": head})
    assert {(r["external_id"], r["outcome"]) for r in got.collect()} == {("1", "fetched"), ("2", "error"), ("3", "fetched")}
    assert registry.items(spark, source | {"max_pages": 1}, {"get": bodies, "fetch": page, "head": head}).count() == 1


def test_named_files(spark, tmp_path):
    (tmp_path / "b.md").write_text("# B")
    source = {"id": "s", "type": "local", "paths": [str(tmp_path / "b.md"), str(tmp_path / "none.md"), str(tmp_path / "b.md")]}
    got = [(r["title"], r["outcome"], r["category"], r["body"], r["discovered"]) for r in registry.items(spark, source).orderBy("discovered").collect()]
    assert got == [("b.md", "fetched", None, "# B", 0), ("none.md", "error", "not-found", None, 1)]
    assert registry.items(spark, {"id": "s", "type": "local", "path": str(tmp_path / "none.md")}).first()["category"] == "not-found"


def test_options_by_type():
    kept = registry.extraction_options({"type": "webdriver", "url": "https://A.b/x", "internal_link_hosts": ["c.d"], "remove_selectors": [".x"]})
    assert kept == {"remove_selectors": [".x"], "preserve_external_links": True, "internal_hosts": ["a.b", "c.d"]}
    assert registry.extraction_options({"type": "website", "sitemap_url": "x"}) == {}
    assert registry.retry_options({"request_max_retries": 5, "request_retry_initial_ms": 250}) == {"attempts": 5, "first": 0.25}


def test_service_desk_falls_back_to_a_crawl(spark):
    source = {"id": "s", "type": "jira-service-management", "url": "https://a/p1", "categories": ["5"], "allowed_url_prefixes": ["https://a/"]}
    silent = lambda url: (200, {"values": [{"id": 9}]}) if "/categories/" in url else (404, {})
    got = registry.items(spark, source, {"get": silent, "fetch": fetch})
    assert got.filter("outcome = 'fetched'").count() == 2
    assert registry.items(spark, source | {"crawl_method": "api"}, {"get": silent, "fetch": fetch}).first()["category"] == "unavailable"


def test_files(spark, tmp_path):
    for name, body in {"a.md": "# A", "x/b.html": "<p>b", "x/private.md": "p", "e.md": "", "c.bin": "z", "ü n.md": "u"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    got = files.file_items(spark, str(tmp_path), "s", None, ["**/*.md", "**/*.html"], ["**/private*"], base_url="https://f/")
    rows = {r["title"]: (r["canonical_url"], r["content_type"], r["body"]) for r in got.collect()}
    assert rows == {"a.md": ("https://f/a.md", "text/markdown", "# A"), "b.html": ("https://f/x/b.html", "text/html", "<p>b"), "ü n.md": ("https://f/%C3%BC%20n.md", "text/markdown", "u")}
    assert files.file_items(spark, str(tmp_path), "s").count() == 1


def test_registry(spark):
    with pytest.raises(ValueError):
        registry.items(spark, {"id": "s", "type": "ftp"})
    registry.register("memory", lambda spark, source, transports: spark.createDataFrame([(source["id"],)], "source_id string"))
    assert registry.items(spark, {"id": "s", "type": "memory"}).count() == 1


def test_embedders(spark):
    assert NoEmbedder(3)(["a"]) == [[0.0, 0.0, 0.0]]
    assert HashEmbedder(8)(["a b"]) == HashEmbedder(8)(["a b"])
    request = lambda p: {"data": [{"index": 1, "embedding": [2.0]}, {"index": 0, "embedding": [1.0]}]}
    assert HttpEmbedder("openai", "m", request)(["a", "b"]) == [[1.0], [2.0]]
    assert HttpEmbedder("vertex-ai", "m", lambda p: {"predictions": [{"embeddings": {"values": [len(i["content"])]}} for i in p["instances"]]})(["abc"]) == [[3]]
    assert fingerprint({"model": "m", "api_key": "1"}) == fingerprint({"api_key": "2", "model": "m"}) != fingerprint({"model": "n"})
    frame = spark.createDataFrame([(str(i), f"t{i}") for i in range(5)] + [("0", "t0")], "content_hash string, content string")
    assert embedded(frame, HashEmbedder(4), size=2).count() == 5
    with pytest.raises(Exception, match="1 vectors for"):
        embedded(frame.coalesce(1), lambda texts: [[1.0]], size=2).collect()


@pytest.fixture()
def site(spark, tmp_path):
    root = tmp_path / "files"
    root.mkdir()
    (root / "a.html").write_text("<html lang='en'><h1>Alpha</h1><p>The first page is about ships and the sea.</p></html>")
    (root / "b.html").write_text("<html lang='en'><h1>Beta</h1><p>The second page is about trains.</p></html>")
    index = {"name": "i", "auto_activate": True, "embedding": {"provider": "hash", "embedding_dimensions": 16}, "sources": [{"id": "s", "type": "local", "root": str(root)}]}
    store = Store(spark, str(tmp_path / "store"))
    refresh = Refresh(spark, store, embedders={"i": HashEmbedder(16)}, verification=Verification(lambda p: '{"verdict": "pass", "reasoning": "ok"}'))
    return root, index, store, refresh


def test_refresh_end_to_end(spark, site):
    root, index, store, refresh = site
    first = refresh.run_index(index)
    assert (first["action"], first["diff"]["added_count"], first["requests"], first["verdict"]) == ("hold", 2, 2, "pass")
    store.activate(first["run_id"])
    again = refresh.run_index(index)
    assert (again["requests"], again["action"], again["diff"]["added_count"], again["diff"]["changed_count"]) == (0, "activate", 0, 0)
    assert [r["canonical_url"].rsplit("/", 1)[1] for r in refresh.search(index, "ships and the sea", 1).collect()] == ["a.html"]
    (root / "b.html").rename(root / "c.html")
    (root / "a.html").write_text("<h1>Alpha</h1><p>The first page changed.</p>")
    third = refresh.run_index(index, Thresholds(max_changed_percentage=0.1))
    assert (third["diff"]["moved_count"], third["diff"]["changed_count"], third["verdict"], third["action"]) == (1, 1, "caution", "hold")
    assert "moved" in third["report"] and third["requests"] == 1
    assert store.pointer("i")["live_run_id"] == again["run_id"]


def test_evidence_results_and_reports_of_a_run(spark, site):
    root, index, store, refresh = site
    index, prompts = index | {"auto_activate": False}, []
    refresh.verification = Verification(lambda p: (prompts.append(p), '{"verdict": "pass", "reasoning": "ok"}')[1])
    store.activate(refresh.run_index(index)["run_id"])
    (root / "a.html").write_text("<html lang='en'><h1>Alpha</h1><p>The first page is about boats and the sea.</p></html>")
    (root / "b.html").unlink()
    prompts.clear()
    second = refresh.run_index(index)
    whole = "\n".join(prompts)
    assert '"removed_segments": ["The first page is about ships and the sea."]' in whole and '"added_segments": ["The first page is about boats and the sea."]' in whole
    assert '"classification": "changed"' in whole and "b.html" in prompts[-1]
    row = store.read("verifications", second["run_id"]).first()
    assert (row["llm_verdict"], row["result_source"], row["final_verdict"]) == ("pass", "provider", second["verdict"])
    assert store.attested(row["input_hash"], ["local"])[1]["verdict"] == "pass"
    assert store.read("reports", second["run_id"]).first()["report"] == second["report"]
    prompts.clear()
    third = refresh.run_index(index)
    assert not prompts and store.read("verifications", third["run_id"]).first()["result_source"] == "cache"
    other = Refresh(spark, store, embedders=refresh.embedders, verification=refresh.verification, attestor="mine", trusted=["local"])
    assert store.read("verifications", other.run_index(index)["run_id"]).first()["result_source"] == "trusted"


def test_the_first_discovered_stays(spark, site):
    _, index, _, refresh = site
    registry.register("twice", lambda spark, source, transports: spark.createDataFrame([("https://a/x", "z first", "text/plain", "one one"), ("https://a/x", "a later", "text/plain", "two two")], "canonical_url string, title string, content_type string, body string").coalesce(1))
    docs, _ = refresh.source_documents({"id": "s", "type": "twice"})
    assert [r["title"] for r in docs.collect()] == ["z first"]


def test_a_failing_index_leaves_the_live_run(spark, site, monkeypatch):
    root, index, store, refresh = site
    monkeypatch.setattr(refresh, "reusable", lambda *a: 1 / 0)
    result = refresh.run_all([index])
    assert "ZeroDivisionError" in result[0]["error"]
    assert [r["lifecycle_status"] for r in store.runs().collect()] == ["error"]
    assert not store.is_locked("i")


def test_command_line(spark, site, tmp_path):
    root, index, store, refresh = site
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"indexes": [index]}))
    said: list[str] = []
    run = lambda *argv: cli.run(["--store", str(store.root), "--config", str(path), *argv], spark, out=said.append)
    assert run("crawl") == 0
    assert run("runs") == 0 and "complete caution" in said[-1]
    run_id = said[-1].split()[0]
    assert run("activate", run_id) == 1
    assert run("activate", run_id, "--allow-caution") == 0
    assert run("search", "--index", "i", "trains") == 0 and "b.html" in "".join(said)
    assert run("reject", run_id) == 1 and run("rollback", "i") == 1 and run("nonsense") == 2
    with store.lock("i"):
        assert run("crawl") == 75


def test_streams_match_batches(spark, tmp_path, base):
    events = spark.read.parquet(f"{base}/events.parquet")
    (tmp_path / "in").mkdir()
    events.coalesce(2).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = streaming.windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    key = lambda df: sorted((str(r["from"]), r["event_type"], r["events"]) for r in df.collect())
    assert key(spark.table("counts")) == key(streaming.windowed_counts(events))
    seen: list[int] = []
    work = lambda df, n: seen.append(streaming.first_seen(df, "ts", "event_id").count())
    for _ in range(2):
        q = streaming.on_each_batch(stream, work, str(tmp_path / "check"))
        q.awaitTermination()
    assert sum(seen) == events.count()
    assert streaming.sessions(events).agg(F.sum("events")).first()[0] == events.count()
