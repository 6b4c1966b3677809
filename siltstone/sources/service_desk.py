"""Articles of a service-desk knowledge base over an injected JSON transport."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.urls import article_id, is_allowed
from siltstone.operators.html_blocks import parse, walk
from siltstone.session import cut
from siltstone.sources import portal_links, web
from siltstone.sources.retry import RequestFailed, failure

ARTICLE = "source_id string, external_id string, canonical_url string, title string, content_type string, body string, outcome string, category string, message string"
Get = Callable[[str], tuple[int, dict]]
Head = Callable[[str], tuple[int, dict]]


class PortalError(RuntimeError):
    pass


def portal_context(html: str) -> dict:
    """workspace, project and categories from the page's embedded JSON; fails loudly where they are missing."""
    for node in walk(parse(html)):
        if node.tag == "script" and "json" in node.attrs.get("type", "") or node.attrs.get("id") == "jsonPayload":
            try:
                payload = json.loads("".join(c for c in node.children if isinstance(c, str)))
            except ValueError:
                continue
            found = {"workspace": payload.get("workspaceId"), "project": payload.get("projectId"), "categories": payload.get("categories") or []}
            if found["workspace"] and found["project"] and found["categories"]:
                return found
    raise PortalError("the portal page has no usable context")


def category_articles(get: Get, base: str, category: str, page_size: int = 50) -> list[dict]:
    """References of a category by offset, until an empty or short page, the total, a missing next or only known ids."""
    found, known, offset = [], set(), 0
    while True:
        status, page = get(f"{base}/categories/{category}/articles?start={offset}&limit={page_size}")
        if not 200 <= status < 300:
            raise RequestFailed(status, f"category {category}")
        values = page.get("values") or []
        fresh = [v for v in values if str(v.get("id")) not in known]
        known.update(str(v.get("id")) for v in fresh)
        found += fresh
        offset += len(values)
        if not fresh or len(values) < page_size or page.get("isLast") or page.get("total") is not None and offset >= page["total"]:
            return found


def article(get: Get, base: str, ref: dict) -> dict:
    """document, skipped (404) or error of one article."""
    url = ref.get("url") or f"{base}/article/{ref['id']}"
    try:
        status, value = get(f"{base}/articles/{ref['id']}")
        if status == 404:
            return {"outcome": "skipped", "category": "not-found", "canonical_url": url, "external_id": str(ref["id"])}
        if not 200 <= status < 300:
            raise RequestFailed(status)
        body = value.get("body")
        if not isinstance(body, str) or not body.strip():
            return {"outcome": "error", "category": "incorrect", "message": "article without a body", "canonical_url": url, "external_id": str(ref["id"])}
    except Exception as problem:  # noqa: BLE001 - the failure is the article's outcome
        return {"outcome": "error", "canonical_url": url, "external_id": str(ref["id"])} | {k: v for k, v in failure(problem).items() if k in ("category", "message")}
    return {"outcome": "fetched", "canonical_url": url, "external_id": str(ref["id"]), "title": value.get("title"), "content_type": "text/html", "body": body}


def articles(refs: DataFrame, get: Get, base: str, source_id: str = "") -> DataFrame:
    """Items of (id, url), asked on the executors."""
    names = [c.split()[0] for c in ARTICLE.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [{"source_id": source_id} | article(get, base, {"id": r.id, "url": r.url}) for r in frame.itertuples()]
            yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype="object")

    return refs.mapInPandas(run, ARTICLE)


def linked_articles(items: DataFrame, base: str, head: Head | None = None) -> DataFrame:
    """(id, url): articles that fetched items link to, each once, with the least of its addresses in context; short links
    by their redirect where head can ask for it."""
    found = web.links(items.filter("outcome = 'fetched'"))
    named = portal_links.article_links(found).select(article_id(F.col("href")).alias("id"), F.col("href").alias("url")).filter("id is not null")
    if head is not None:
        codes = portal_links.resolved_codes(portal_links.short_codes(found, ["{0.scheme}://{0.netloc}".format(urlsplit(base))]), head)
        named = named.unionByName(codes.select("id", F.lit(None).cast("string").alias("url")))
    return named.groupBy("id").agg(F.min("url").alias("url"))


def discover(spark: SparkSession, get: Get, base: str, categories: list[str], source_id: str = "", prefixes=(), denied=(), max_pages: int = 1000, page_size: int = 50, starts=(), head: Head | None = None) -> DataFrame:
    """Articles of the start pages, of the categories and those they link to, each once and at most max_pages, wave by
    wave: bodies stay on the executors, the driver remembers at most max_pages ids. If no article at all can be read,
    one anomaly stands for the service."""
    refs = [{"id": n} for n in dict.fromkeys(map(portal_links.article_number, starts)) if n]
    refs += [r for c in categories for r in category_articles(get, base, c, page_size)]
    seen: set[str] = set()
    result = None

    def fresh(found: list[dict]) -> list[tuple[str, str]]:
        """New ones of the allowed, as many as there is room for."""
        wave = []
        for ref in found:
            number, url = str(ref["id"]), ref.get("url") or f"{base}/article/{ref['id']}"
            if number not in seen and len(seen) < max_pages and is_allowed(url, prefixes, denied):
                seen.add(number)
                wave.append((number, url))
        return wave

    wave = fresh(refs)
    while wave:
        frame = spark.createDataFrame(wave, "id string, url string").repartition(max(1, min(len(wave), 64)))
        got = cut(articles(frame, get, base, source_id))
        result = got if result is None else result.unionByName(got)
        more = linked_articles(got, base, head).orderBy("id") if len(seen) < max_pages else None
        wave = fresh([{"id": r["id"]} for r in more.toLocalIterator()]) if more is not None else []
    if result is None:
        return spark.createDataFrame([], ARTICLE)
    if result.filter("not category <=> 'not-found'").isEmpty():
        return spark.createDataFrame([(source_id, None, base, None, None, None, "error", "unavailable", "the article service answers nothing")], ARTICLE)
    return result
