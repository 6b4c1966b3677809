"""URL column functions."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where knowledge-base addresses carry a numeric article id, in order of preference.
ARTICLE_PATTERNS = (
    r"/article/(\d+)",
    r"/articles/view/(\d+)",
    r"/kb/view/(\d+)",
    r"/pages/(\d+)",
    r"/plugins/servlet/servicedesk/customer/confluence/shim/spaces/[^/]+/pages/(\d+)",
    r"/wiki/spaces/[^/]+/pages/(\d+)",
)


def host(url: Column) -> Column:
    """Lower-case host, null for what can't be parsed."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def origin(url: Column) -> Column:
    """scheme://host[:port] without user information."""
    scheme, authority = F.try_parse_url(url, F.lit("PROTOCOL")), F.try_parse_url(url, F.lit("AUTHORITY"))
    return F.concat(scheme, F.lit("://"), F.regexp_replace(authority, r"^.*@", ""))


def web_host(url: Column) -> Column:
    """Lower-case host of http and https addresses only."""
    return F.when(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https"), host(url))


def article_id(url: Column, patterns: tuple[str, ...] = ARTICLE_PATTERNS) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), p, 1), F.lit("")) for p in patterns])


def segment_after(url: Column, name: str) -> Column:
    """The path segment after /name/."""
    return F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), rf"/{name}/([^/?#]+)", 1), F.lit(""))


def reportable(url: Column) -> Column:
    """Without query, fragment and user information."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/@]*@", "$1")


def allowed(url: Column, prefixes: list[str] | None = None, denied: list[str] | None = None, denied_prefixes: list[str] | None = None) -> Column:
    """Non-empty, under one of the prefixes (if there are any), and neither denied nor under a denied prefix."""
    ok = F.coalesce(F.length(url) > 0, F.lit(False))
    if prefixes:
        ok &= reduce(lambda a, b: a | b, [url.startswith(p) for p in prefixes])
    if denied:
        ok &= ~url.isin(*denied)
    for prefix in denied_prefixes or []:
        ok &= ~url.startswith(prefix)
    return ok


def is_allowed(url: str | None, prefixes=(), denied=(), denied_prefixes=()) -> bool:
    """allowed() for one address, on the driver."""
    return bool(url) and (not prefixes or any(url.startswith(p) for p in prefixes)) and url not in set(denied or ()) and not any(url.startswith(p) for p in denied_prefixes or ())


def resolve(base: str | None, href: str | None) -> str | None:
    """href made absolute against base, with dot segments resolved and without fragment; null where that fails."""
    if base is None or href is None:
        return None
    try:
        parts = urlsplit(urljoin(base, href.strip()))
    except ValueError:
        return None
    if not parts.scheme:
        return None
    return urlunsplit((parts.scheme, parts.netloc, quote(parts.path, safe="/%:@!$&'()*+,;=~-._"), quote(parts.query, safe="/?%:@!$&'()*+,;=~-._[]"), ""))


@F.pandas_udf(T.StringType())
def resolved(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([resolve(b, h) for b, h in zip(base, href)], dtype=object)


def preference_score(url: Column, substrings: list[str]) -> Column:
    """How many of the preferred substrings an address contains."""
    return reduce(lambda a, b: a + b, [url.contains(s).cast("int") for s in substrings], F.lit(0))
