"""Sitemaps, page fetches and link crawls over an injected transport.

fetch(url) -> (status, headers, body) is the only way out; it has to be picklable. A frontier goes in waves: a wave's
pages are fetched on the executors, its links become the next wave by an anti-join with what was seen.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.urls import is_allowed, origin, resolve, web_host
from siltstone.operators.html_blocks import parse, walk
from siltstone.session import cut
from siltstone.sources.retry import RequestFailed, failure, with_retries

Fetch = Callable[[str], tuple[int, dict, str]]
ITEM = "source_id string, canonical_url string, content_type string, body string, outcome string, category string, message string, status int"


def start_urls(source: dict) -> list[str]:
    """start_urls before start_url before url."""
    if source.get("start_urls"):
        return list(source["start_urls"])
    return [u for u in (source.get("start_url") or source.get("url"),) if u]


def internal_hosts(source: dict) -> list[str]:
    from urllib.parse import urlsplit

    hosts = [(urlsplit(u).hostname or "").lower() for u in start_urls(source)] + [h.lower() for h in source.get("internal_link_hosts") or ()]
    return list(dict.fromkeys(h for h in hosts if h))


def sitemap_locations(bodies: DataFrame) -> DataFrame:
    """(parent, kind, location) of sitemaps (url, body): pages of a urlset, children of a sitemapindex."""

    def of(kind: str, outer: str):
        path = f"//*[local-name()='{outer}']/*[local-name()='loc']/text()"
        found = F.filter(F.transform(F.xpath("body", F.lit(path)), lambda x: F.trim(x)), lambda x: x != "")
        return bodies.select(F.col("url").alias("parent"), F.lit(kind).alias("kind"), F.explode(found).alias("location"))

    return of("page", "url").unionByName(of("sitemap", "sitemap"))


def fetched(urls: DataFrame, fetch: Fetch, source_id: str = "", delay: float = 0.0, attempts: int = 3, sleep: Callable[[float], None] = time.sleep, **waits: float) -> DataFrame:
    """Items of (canonical_url[, content_type]). Failures are outcomes: 404 is skipped, the rest are errors. With a
    delay, rows are placed by host, so that one task owns a host and spaces its requests."""
    placed = urls.withColumn("host", F.coalesce(web_host(F.col("canonical_url")), F.lit("")))
    placed = placed.repartition("host") if delay else placed

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for frame in parts:
            rows = []
            for row in frame.itertuples():
                if delay:
                    wait = last.get(row.host, -1e9) + delay - time.monotonic()
                    if wait > 0:
                        sleep(wait)
                    last[row.host] = time.monotonic()

                def call(url=row.canonical_url):
                    status, headers, body = fetch(url)
                    if not 200 <= status < 300:
                        raise RequestFailed(status, retry_after={k.lower(): v for k, v in headers.items()}.get("retry-after"))
                    return headers, body

                try:
                    headers, body = with_retries(call, attempts, sleep=sleep, **waits)
                    kind = {k.lower(): v for k, v in headers.items()}.get("content-type") or getattr(row, "content_type", None) or "text/html"
                    rows.append((source_id, row.canonical_url, kind, body, "fetched", None, None, 200))
                except Exception as problem:  # noqa: BLE001 - the failure is the item's outcome
                    f = failure(problem)
                    rows.append((source_id, row.canonical_url, None, None, "skipped" if f["category"] == "not-found" else "error", f["category"], f["message"], f["status"]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ITEM.split(", ")])

    return placed.mapInPandas(run, ITEM)


def discover_sitemaps(spark: SparkSession, roots: list[str], fetch: Fetch, prefixes=(), denied=(), denied_prefixes=(), max_depth: int = 10, source_id: str = "") -> DataFrame:
    """(source_id, canonical_url, sitemap_url): pages of the sitemaps, children of an index only from its own origin.
    Each level is one wave; a child already on its own path isn't followed again; going deeper than max_depth fails."""
    if not roots:
        raise ValueError("no sitemap")
    frontier = spark.createDataFrame([(r, [r]) for r in roots], "canonical_url string, path array<string>")
    pages = None
    for depth in range(max_depth + 2):
        if frontier.isEmpty():
            break
        if depth > max_depth:
            raise ValueError(f"sitemaps are nested deeper than {max_depth}")
        got = cut(fetched(frontier.select("canonical_url").distinct(), fetch, source_id))
        problem = got.filter("outcome <> 'fetched'").first()
        if problem:
            raise RequestFailed(problem["status"], f"{problem['canonical_url']}: {problem['message']}")
        found = sitemap_locations(got.select(F.col("canonical_url").alias("url"), "body"))
        own = found.filter("kind = 'page'").select(F.lit(source_id).alias("source_id"), F.col("location").alias("canonical_url"), F.col("parent").alias("sitemap_url"))
        pages = own if pages is None else pages.unionByName(own)
        children = found.filter("kind = 'sitemap'").filter(origin(F.col("location")).eqNullSafe(origin(F.col("parent"))))
        frontier = cut(
            children.join(frontier, children["parent"] == frontier["canonical_url"])
            .filter(~F.array_contains("path", F.col("location")))
            .select(F.col("location").alias("canonical_url"), F.concat("path", F.array("location")).alias("path"))
        )
    from siltstone.functions.urls import allowed

    return pages.filter(allowed(F.col("canonical_url"), list(prefixes), list(denied), list(denied_prefixes))).dropDuplicates(["canonical_url"])


def links(items: DataFrame) -> DataFrame:
    """(canonical_url, href): absolute links of fetched pages, without fragments."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in parts:
            rows = []
            for row in frame.itertuples():
                for node in walk(parse(row.body or "")):
                    if node.tag == "a" and (href := resolve(row.canonical_url, node.attrs.get("href"))):
                        rows.append((row.canonical_url, href))
            yield pd.DataFrame(rows, columns=["canonical_url", "href"])

    return items.select("canonical_url", "body").mapInPandas(run, "canonical_url string, href string")


def crawl(spark: SparkSession, starts: list[str], fetch: Fetch, prefixes=(), denied=(), denied_prefixes=(), max_pages: int = 1000, requeues: int = 2, source_id: str = "", delay: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Items reached from the start pages, wave by wave: never a page twice, never more than max_pages, failed pages
    tried again at most `requeues` times. max_pages bounds what the driver remembers."""
    from siltstone.functions.urls import allowed

    wave = [u for u in dict.fromkeys(starts) if is_allowed(u, prefixes, denied, denied_prefixes)][:max_pages]
    seen, tries, result = set(wave), dict.fromkeys(wave, 0), None
    while wave:
        frame = spark.createDataFrame([(u,) for u in wave], "canonical_url string")
        got = cut(fetched(frame.repartition(max(1, min(len(wave), 64))), fetch, source_id, delay, 1, sleep))
        again = [r["canonical_url"] for r in got.filter("outcome = 'error'").select("canonical_url").toLocalIterator() if tries[r["canonical_url"]] < requeues]
        for url in again:
            tries[url] += 1
        done = got.filter(~F.col("canonical_url").isin(again)) if again else got
        result = done if result is None else result.unionByName(done)
        room = max_pages - len(seen)
        known = spark.createDataFrame([(u,) for u in seen], "href string")
        fresh = links(got.filter("outcome = 'fetched'")).filter(allowed(F.col("href"), list(prefixes), list(denied), list(denied_prefixes)))
        new = [r["href"] for r in fresh.select("href").distinct().join(known, "href", "left_anti").orderBy("href").limit(max(0, room)).toLocalIterator()] if room > 0 else []
        seen.update(new)
        tries.update(dict.fromkeys(new, 0))
        wave = again + new
    return result if result is not None else spark.createDataFrame([], ITEM)
