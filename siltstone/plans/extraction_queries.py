"""Queries of extraction, chunking and language choice, with SQL over what the tables themselves hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text, urls
from siltstone.operators import language_choice, pipeline
from siltstone.session import spread, table
from siltstone.sources import web
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


HTML = "(starts_with(content_type, 'text/html') OR starts_with(content_type, 'application/xhtml'))"


def _pages(spark: SparkSession, base: str, *kinds: str) -> DataFrame:
    pages = table(spark, base, "pages").select("page_id", "source_id", "canonical_url", "title", "content_type", "body").distinct()
    fit = F.lit(False)
    for kind in kinds:
        fit |= F.col("content_type").startswith(kind)
    return pages.filter(fit) if kinds else pages


def _extracted(pages: DataFrame, options: dict | None = None) -> DataFrame:
    return pipeline.documents(pages, options).filter("outcome = 'document'")


@query(
    f"""SELECT page_id, n AS block_no, b.type AS type, b.text AS text, array_to_string(b.heading_path, ' > ') AS path FROM (
      SELECT page_id, unnest(range(0, len(blocks))) AS n, unnest(blocks) AS b FROM (SELECT DISTINCT page_id, blocks FROM pages WHERE {HTML} AND len(blocks) > 0))"""
)
def html_block_paths(spark: SparkSession, base: str) -> DataFrame:
    """Type, text and heading path of every block of the HTML pages."""
    found = _extracted(_pages(spark, base, "text/html", "application/xhtml"))
    return found.select("page_id", F.posexplode("new_blocks").alias("block_no", "b")).select("page_id", F.col("block_no").cast("long").alias("block_no"), "b.type", "b.text", F.array_join("b.heading_path", " > ").alias("path"))


@query(
    f"""SELECT page_id, array_to_string(list_transform(list_filter(blocks, lambda b: b.type NOT IN ('list-item', 'code', 'table-cell')), lambda b: b.text), chr(10)) AS texts
    FROM (SELECT DISTINCT page_id, blocks FROM pages WHERE {HTML} AND len(list_filter(blocks, lambda b: b.type NOT IN ('list-item', 'code', 'table-cell'))) > 0)"""
)
def html_without_lists(spark: SparkSession, base: str) -> DataFrame:
    """HTML pages without what selectors remove, equal elements among it: list entries, code and tables."""
    found = _extracted(_pages(spark, base, "text/html", "application/xhtml"), {"remove_selectors": ["li", "pre, code", "body table"]})
    return found.select("page_id", F.array_join(F.transform("new_blocks", lambda b: b["text"]), "\n").alias("texts"))


@query(
    """SELECT page_id, array_to_string(list_transform(list_filter(blocks, lambda b: b.type = 'heading'), lambda b: b.text), chr(10)) AS headings
    FROM (SELECT DISTINCT page_id, blocks FROM pages WHERE starts_with(content_type, 'text/markdown') AND len(blocks) > 0)"""
)
def markdown_headings(spark: SparkSession, base: str) -> DataFrame:
    found = _extracted(_pages(spark, base, "text/markdown"))
    return found.select("page_id", F.array_join(F.transform(F.filter("new_blocks", lambda b: b["type"] == "heading"), lambda b: b["text"]), "\n").alias("headings"))


@query(
    """SELECT page_id, CAST(len(list_filter(string_split_regex(replace(replace(body, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\\n[ \\t\\n\\x0B\\f]*\\n'), lambda p: trim(p, E' \\t\\n') <> '')) AS INT) AS blocks
    FROM (SELECT DISTINCT page_id, body FROM pages WHERE starts_with(content_type, 'text/plain') AND trim(coalesce(body, ''), E' \\t\\n\\r') <> '')"""
)
def plain_paragraphs(spark: SparkSession, base: str) -> DataFrame:
    """The number of paragraphs of each plain-text page."""
    return _extracted(_pages(spark, base, "text/plain")).select("page_id", F.size("new_blocks").alias("blocks"))


@query(
    """SELECT DISTINCT page_id, source_id, CASE WHEN len(blocks) > 0 THEN 'document' ELSE 'skipped' END AS outcome, sha256(coalesce(body, '')) AS raw_content_hash FROM pages"""
)
def page_outcomes(spark: SparkSession, base: str) -> DataFrame:
    """What becomes of every page, and the hash of its body as it came."""
    found = pipeline.documents(_pages(spark, base))
    return found.select("page_id", "source_id", "outcome", F.coalesce("raw_content_hash", text.content_hash(F.col("body"))).alias("raw_content_hash"))


@query(f"""SELECT page_id, nullif(regexp_extract(body, '<html[^>]*\\slang="([^"]*)"', 1), '') AS html_locale FROM (SELECT DISTINCT page_id, body FROM pages WHERE {HTML} AND len(blocks) > 0)""")
def page_locales(spark: SparkSession, base: str) -> DataFrame:
    return _extracted(_pages(spark, base, "text/html", "application/xhtml")).select("page_id", "html_locale")


@query(f"SELECT page_id, CAST(len(regexp_extract_all(body, '<a [^>]*href=')) AS INT) AS links FROM (SELECT DISTINCT page_id, body FROM pages WHERE {HTML} AND len(blocks) > 0)")
def kept_links(spark: SparkSession, base: str) -> DataFrame:
    """Links kept in the text where no host counts as internal."""
    found = _extracted(_pages(spark, base, "text/html", "application/xhtml"), {"preserve_external_links": True})
    whole = F.array_join(F.transform("new_blocks", lambda b: b["text"]), "\n")
    return found.select("page_id", F.regexp_count(whole, F.lit(r"\]\(<https?://")).alias("links"))


@query(
    f"""SELECT page_id, array_to_string(list_transform(blocks, lambda b: b.text), chr(10)) AS texts, coalesce(title, CAST(page_id AS VARCHAR)) AS title
    FROM (SELECT DISTINCT page_id, title, blocks FROM pages WHERE {HTML} AND len(blocks) > 0)"""
)
def json_html_fields(spark: SparkSession, base: str) -> DataFrame:
    """HTML inside typed fields of JSON documents, made of the HTML pages, with a title by its path."""
    pages = _pages(spark, base, "text/html", "application/xhtml").filter("body is not null")
    part = F.struct(F.lit("content_text").alias("type"), F.col("body").alias("content"))
    other = F.struct(F.lit("note").alias("type"), F.lit("<p>left out</p>").alias("content"))
    made = F.to_json(F.struct(F.struct(F.coalesce("title", F.col("page_id").cast("string")).alias("head")).alias("meta"), F.array(other, part).alias("parts")))
    items = pages.select("page_id", "canonical_url", F.lit(None).cast("string").alias("title"), F.lit("application/json").alias("content_type"), made.alias("body"))
    found = _extracted(items, {"json_extract": {"mode": "html-fields", "title_path": ["meta", "head"]}})
    return found.select("page_id", F.array_join(F.transform("new_blocks", lambda b: b["text"]), "\n").alias("texts"), F.col("doc_title").alias("title"))


@query("SELECT event_id, 'k: ' || json_extract_string(props, '$.k') AS texts FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_scalars(spark: SparkSession, base: str) -> DataFrame:
    events = table(spark, base, "events").filter("props is not null")
    items = events.select("event_id", F.lit(None).cast("string").alias("canonical_url"), F.lit(None).cast("string").alias("title"), F.lit("application/json").alias("content_type"), F.col("props").alias("body"))
    return _extracted(items).select("event_id", F.array_join(F.transform("new_blocks", lambda b: b["text"]), "\n").alias("texts"))


@query(
    """SELECT id, 'embedding_fingerprint,auto_activate' AS headed, 'fingerprint: ' || json_extract_string(metadata, '$.embedding_fingerprint') AS first_text, 'state: ' || lifecycle_status AS last_text
    FROM (SELECT DISTINCT id, metadata, lifecycle_status FROM kb_runs) WHERE json_extract_string(metadata, '$.embedding_fingerprint') IS NOT NULL"""
)
def json_trees(spark: SparkSession, base: str) -> DataFrame:
    """Nested JSON of the runs: containers become headings, scalars paragraphs below their path."""
    mark = F.get_json_object("metadata", "$.embedding_fingerprint")
    runs = table(spark, base, "kb_runs").select("id", "metadata", "lifecycle_status").distinct().filter(mark.isNotNull())
    made = F.to_json(F.struct(F.struct(mark.alias("fingerprint")).alias("embedding_fingerprint"), F.array(F.struct(F.lit(True).alias("on"))).alias("auto_activate"), F.col("lifecycle_status").alias("state")), {"ignoreNullFields": "false"})
    items = runs.select("id", F.lit(None).cast("string").alias("canonical_url"), F.lit(None).cast("string").alias("title"), F.lit("application/json").alias("content_type"), made.alias("body"))
    found = _extracted(items).withColumn("heads", F.filter("new_blocks", lambda b: (b["type"] == "heading") & (F.size(b["heading_path"]) == 1)))
    texts = F.filter("new_blocks", lambda b: b["type"] == "paragraph")
    return found.select("id", F.array_join(F.transform("heads", lambda b: b["text"]), ",").alias("headed"), F.element_at(texts, 1)["text"].alias("first_text"), F.element_at(texts, -1)["text"].alias("last_text"))


@query(
    """SELECT extract_id, md5(regexp_replace(array_to_string(list_transform(blocks, lambda b: coalesce(b.text, '')), ''), '[^\\p{L}\\p{N}]', '', 'g')) AS letters, true AS numbered, true AS within
    FROM (SELECT DISTINCT extract_id, blocks FROM extracted_documents) WHERE regexp_matches(array_to_string(list_transform(blocks, lambda b: coalesce(b.text, '')), ''), '[^ \\t\\n\\r\\f\\x0B]')"""
)
def chunk_invariants(spark: SparkSession, base: str) -> DataFrame:
    """Of each record: that its chunks hold every letter of its blocks in order, are numbered without gaps and keep to
    the budget. Heading paths are left out, as chunks repeat them."""
    docs = table(spark, base, "extracted_documents").select("extract_id", "blocks").distinct().filter("blocks is not null")
    plain = F.transform("blocks", lambda b: F.struct(b["type"].alias("type"), F.coalesce(b["text"], F.lit("")).alias("text"), F.array().cast("array<string>").alias("heading_path")))
    found = pipeline.chunks(docs.select("extract_id", plain.alias("blocks")), 200).groupBy("extract_id").agg(
        F.array_sort(F.collect_list(F.struct("chunk_index", "content", "chunk_count"))).alias("c"), F.max("estimated_tokens").alias("most")
    )
    whole = F.array_join(F.transform("c", lambda x: x["content"]), "")
    numbered = F.forall(F.transform("c", lambda x, i: (x["chunk_index"] == i) & (x["chunk_count"] == F.size("c"))), lambda ok: ok)
    return found.select("extract_id", F.md5(F.regexp_replace(whole, r"[^\p{L}\p{N}]", "")).alias("letters"), numbered.alias("numbered"), (F.col("most") <= 200).alias("within"))


def _language_sql() -> str:
    hits = ", ".join(
        "{'n': len(list_filter(words, lambda w: list_contains([" + ", ".join(f"'{w}'" for w in v.split()) + f"], w))), 'locale': '{k}'}}" for k, v in sorted(language_choice.MARKERS.items())
    )
    return f"""WITH rows AS (SELECT DISTINCT extract_id, nullif(lower(split_part(replace(html_locale, '_', '-'), '-', 1)), '') AS tag, trim(coalesce(normalized_content, '')) <> '' AS has_text,
      string_split_regex(lower(coalesce(normalized_content, '')), '[^\\p{{L}}]+') AS words FROM extracted_documents),
    counted AS (SELECT *, [{hits}] AS hits FROM rows),
    best AS (SELECT *, list_reverse_sort(hits)[1] AS top, list_sum(list_transform(hits, lambda h: h.n)) AS total FROM counted)
    SELECT DISTINCT extract_id, CASE WHEN tag IS NOT NULL THEN tag WHEN has_text AND total > 0 THEN top.locale ELSE 'en' END AS locale,
      CASE WHEN tag IS NOT NULL THEN 'html' WHEN has_text AND total > 0 THEN 'detected' ELSE 'fallback' END AS language_source,
      CASE WHEN tag IS NOT NULL THEN 1.0 WHEN has_text AND total > 0 THEN round(top.n / total, 4) END AS confidence FROM best"""


@query(_language_sql())
def document_languages(spark: SparkSession, base: str) -> DataFrame:
    docs = spread(table(spark, base, "extracted_documents").select("extract_id", "html_locale", "normalized_content"))
    found = language_choice.annotated(docs, mode="auto", fallback="en")
    return found.select("extract_id", "locale", "language_source", F.round("language_confidence", 4).alias("confidence")).distinct()


@query(
    """SELECT tag AS locale, CASE WHEN tag IS NULL THEN 'unknown' ELSE 'html' END AS language_source, count(*) AS records FROM (
      SELECT CASE WHEN nullif(lower(split_part(replace(html_locale, '_', '-'), '-', 1)), '') IN ('de', 'en', 'fr') THEN lower(split_part(replace(html_locale, '_', '-'), '-', 1)) END AS tag FROM (SELECT DISTINCT extract_id, html_locale FROM extracted_documents)) GROUP BY ALL"""
)
def allowed_languages(spark: SparkSession, base: str) -> DataFrame:
    """The page's own language where it is an allowed one."""
    docs = table(spark, base, "extracted_documents").select("extract_id", "html_locale", F.lit("").alias("normalized_content")).dropDuplicates(["extract_id", "html_locale"])
    found = language_choice.annotated(docs, mode="html", allowed=["de", "en", "fr"])
    return found.groupBy("locale", "language_source").agg(F.count(F.lit(1)).alias("records"))


@query(
    """SELECT DISTINCT canonical_url, CASE WHEN scheme <> '' THEN lower(scheme) || regexp_replace(regexp_replace(substr(u, length(scheme) + 1), '[?#].*$', ''), '[^/]*$', '') || 'b' END AS sibling,
      CASE WHEN scheme <> '' THEN lower(scheme) || regexp_extract(substr(u, length(scheme) + 1), '^(://[^/?#]+)', 1) || '/x?q=1' END AS rooted
    FROM (SELECT canonical_url, u, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme FROM (SELECT canonical_url, trim(canonical_url, E' \\t\\n\\r') AS u FROM run_documents))"""
)
def resolved_links(spark: SparkSession, base: str) -> DataFrame:
    """Links made absolute against the address of the document they stand in; nulls where that has no scheme."""
    u = F.regexp_replace("canonical_url", r"^[ \t\n\r]+|[ \t\n\r]+$", "")
    rows = table(spark, base, "run_documents").select("canonical_url", u.alias("u")).distinct()
    return rows.select("canonical_url", urls.resolved(F.col("u"), F.lit("./a/../b#top")).alias("sibling"), urls.resolved(F.col("u"), F.lit("/x?q=1#y")).alias("rooted")).distinct()


@query(
    """SELECT d.source_id, count(*) AS documents, count(*) FILTER (WHERE lower(regexp_extract(d.u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)) = lower(regexp_extract(s.site_url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1))) AS same_origin
    FROM (SELECT lower(trim(source_id, E' \\t\\n\\r')) AS source_id, trim(canonical_url, E' \\t\\n\\r') AS u FROM run_documents) d JOIN (SELECT DISTINCT source_id, site_url FROM kb_sources) s ON s.source_id = d.source_id GROUP BY d.source_id"""
)
def same_origin(spark: SparkSession, base: str) -> DataFrame:
    """How many documents of each source lie on the site it names."""
    sites = table(spark, base, "kb_sources").select("source_id", "site_url").distinct()
    rows = table(spark, base, "run_documents").select(F.lower(F.regexp_replace("source_id", r"^[ \t\n\r]+|[ \t\n\r]+$", "")).alias("source_id"), F.regexp_replace("canonical_url", r"^[ \t\n\r]+|[ \t\n\r]+$", "").alias("u"))
    same = F.lower(urls.origin(F.col("u"))) == F.lower(urls.origin(F.col("site_url")))
    return rows.join(sites, "source_id").groupBy("source_id").agg(F.count(F.lit(1)).alias("documents"), F.count_if(same).alias("same_origin"))


@query("SELECT DISTINCT canonical_url, CASE regexp_extract(regexp_replace(canonical_url, '^.*/', ''), 'lang=([a-z]{2})', 1) WHEN 'en' THEN 'en-GB' WHEN 'de' THEN 'de-DE' WHEN 'fr' THEN 'fr-FR' END AS locale FROM run_documents WHERE canonical_url IS NOT NULL")
def file_name_locales(spark: SparkSession, base: str) -> DataFrame:
    mapping = {"en": "en-GB", "de": "de-DE", "fr": "fr-FR"}
    return table(spark, base, "run_documents").filter("canonical_url is not null").select("canonical_url", text.locale_of_file(F.col("canonical_url"), "lang=([a-z]{2})", mapping).alias("locale")).distinct()


@query("SELECT DISTINCT id, title, length(trim(regexp_replace(coalesce(title, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))) >= 30 AS meaningful FROM run_documents")
def meaningful_titles(spark: SparkSession, base: str) -> DataFrame:
    """Titles of 30 characters or more once white space is normalised."""
    return table(spark, base, "run_documents").select("id", "title", text.is_meaningful(F.col("title"), 30, fold=False).alias("meaningful")).distinct()


@query("SELECT DISTINCT d.source_id, trim(canonical_url, E' \\t\\n\\r') AS location FROM run_documents d WHERE trim(coalesce(canonical_url, ''), E' \\t\\n\\r') <> ''")
def sitemap_locations(spark: SparkSession, base: str) -> DataFrame:
    """Addresses read from sitemaps: one for each address listed, as several deliveries of a site's map."""
    rows = table(spark, base, "run_documents").select("source_id", "canonical_url").distinct().filter("canonical_url is not null")
    escaped = F.replace(F.replace("canonical_url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><url><loc> "), escaped, F.lit(" </loc></url><url><loc> </loc></url></urlset>"))
    found = web.sitemap_locations(rows.select(F.col("source_id").alias("url"), body.alias("body")))
    return found.filter("kind = 'page'").select(F.col("parent").alias("source_id"), F.regexp_replace("location", r"^\s+|\s+$", "").alias("location")).distinct()


@query(
    f"""SELECT DISTINCT page_id, 'https://site.example' || regexp_replace(href, '#.*$', '') AS href FROM (SELECT page_id, unnest(regexp_extract_all(body, '<a [^>]*href="([^"]*)"', 1)) AS href FROM (SELECT DISTINCT page_id, body FROM pages WHERE {HTML})) WHERE starts_with(href, '/')"""
)
def page_links(spark: SparkSession, base: str) -> DataFrame:
    """Links of the HTML pages, absolute and without fragments."""
    pages = _pages(spark, base, "text/html", "application/xhtml")
    found = web.links(pages.select(F.concat(F.lit("https://site.example/p/"), "page_id").alias("canonical_url"), "body"))
    return found.filter("startswith(href, 'https://site.example/') and not startswith(href, 'https://site.example/p/')").select(F.regexp_extract("canonical_url", r"(\d+)$", 1).cast("long").alias("page_id"), "href").distinct()


@query("SELECT DISTINCT user_id, event_type FROM events")
def first_seen_events(spark: SparkSession, base: str) -> DataFrame:
    """Keep-first of a stream in its batch form, an address being a user and an event."""
    events = table(spark, base, "events").withColumn("address", F.concat_ws("/", "user_id", "event_type"))
    return streaming.first_seen(events, "ts", "address").select("user_id", "event_type")


@query(
    """WITH RECURSIVE listed AS (SELECT user_id, event_id, epoch_us(ts) AS arrival, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    started AS (SELECT user_id, event_id, arrival, n, arrival AS begun FROM listed WHERE n = 1
      UNION ALL SELECT l.user_id, l.event_id, l.arrival, l.n, greatest(l.arrival, s.begun + 7200000000) FROM started s JOIN listed l ON l.user_id = s.user_id AND l.n = s.n + 1)
    SELECT event_id, begun - arrival AS waited FROM started"""
)
def spaced_requests(spark: SparkSession, base: str) -> DataFrame:
    """How long the events of a user would wait if they had to start two hours apart."""
    return streaming.spaced_starts(table(spark, base, "events"), "user_id", "ts", "event_id", 7200).select("event_id", "waited")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)
