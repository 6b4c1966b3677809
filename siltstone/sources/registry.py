"""Source types by name; new ones are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources import files, service_desk, web

_SOURCES: dict[str, Callable[[SparkSession, dict, dict], DataFrame]] = {}


def register(kind: str, discover: Callable[[SparkSession, dict, dict], DataFrame]) -> None:
    """discover(spark, source, transports) -> fetched items."""
    _SOURCES[kind] = discover


def items(spark: SparkSession, source: dict, transports: dict | None = None) -> DataFrame:
    """Fetched items of a source; unknown types fail."""
    kind = source.get("type")
    if kind not in _SOURCES:
        raise ValueError(f"unsupported source type {kind}")
    return _SOURCES[kind](spark, source, transports or {})


def _limits(source: dict) -> dict:
    return {"prefixes": source.get("allowed_url_prefixes") or (), "denied": source.get("denied_urls") or (), "denied_prefixes": source.get("denied_url_prefixes") or ()}


def retry_options(settings: dict, prefix: str = "request_") -> dict:
    """Options of with_retries() from the settings of a source, provider or verifier; what isn't set has its default."""
    named = {"attempts": (f"{prefix}max_retries", 1), "first": (f"{prefix}retry_initial_ms", 1000), "jitter": (f"{prefix}retry_jitter_ms", 1000), "longest": (f"{prefix}retry_max_delay_ms", 1000)}
    return {name: settings[key] / per if per > 1 else settings[key] for name, (key, per) in named.items() if settings.get(key) is not None}


def _website(spark, source, transports):
    roots = source.get("sitemap_urls") or [u for u in (source.get("sitemap_url"),) if u]
    pages = web.discover_sitemaps(spark, roots, transports["fetch"], max_depth=source.get("max_sitemap_depth", 10), source_id=source["id"], **_limits(source))
    return web.fetched(pages, transports["fetch"], source["id"], source.get("inter_request_delay_ms", 0) / 1000, **retry_options(source))


def _browser(spark, source, transports):
    return web.crawl(spark, web.start_urls(source), transports["fetch"], max_pages=source.get("max_pages", 1000), source_id=source["id"], **_limits(source))


def _desk(spark, source, transports):
    if source.get("crawl_method") == "webdriver" or "get" not in transports:
        return _browser(spark, source, transports)
    starts = web.start_urls(source)
    categories = source.get("categories")
    if categories is None and "fetch" in transports:
        categories = [str(c["id"]) for c in service_desk.portal_context(transports["fetch"](starts[0])[2])["categories"]]
    found = service_desk.discover(
        spark, transports["get"], starts[0].rstrip("/"), categories or [], source["id"], source.get("allowed_url_prefixes") or (), source.get("denied_urls") or (),
        max_pages=source.get("max_pages", 1000), page_size=source.get("api_page_limit", 50), starts=starts, head=transports.get("head"),
    )
    if source.get("crawl_method", "auto") == "auto" and "fetch" in transports and not found.filter("category = 'unavailable'").isEmpty():
        return _browser(spark, source, transports)
    return found


def _files(scheme: str):
    def discover(spark, source, transports):
        if scheme == "file" and not source.get("root"):
            return files.path_items(spark, source.get("paths") or [source["path"]], source["id"])
        root = source.get("root") or f"{scheme}://{source['bucket']}/{source.get('prefix', '')}"
        return files.file_items(spark, root, source["id"], tuple(source["extensions"]) if source.get("extensions") else (("html", "htm") if scheme == "file" else None), source.get("include_globs"), source.get("exclude_globs"), source.get("max_pages", 1000 if scheme != "file" else None), source.get("base_url"))

    return discover


#: Types whose links to other hosts stay in the text.
KEEPS_LINKS = ("jira-service-management", "webdriver")


def extraction_options(source: dict) -> dict:
    """Options of the extraction of a source's pages, by its settings and its type."""
    options = {k: source[k] for k in ("content_selectors", "remove_selectors", "strip_text", "json_extract", "language_selectors") if source.get(k)}
    if source.get("preserve_external_links", source.get("type") in KEEPS_LINKS):
        options |= {"preserve_external_links": True, "internal_hosts": web.internal_hosts(source)}
    return options


register("website", _website)
register("webdriver", _browser)
register("jira-service-management", _desk)
register("local", _files("file"))
register("s3", _files("s3a"))
register("gcs", _files("gs"))
