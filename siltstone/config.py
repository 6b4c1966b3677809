"""Configuration: YAML-shaped mappings, checked as a whole before anything runs."""

from __future__ import annotations

import hashlib
import json
import os
import re
from datetime import timedelta

REFERENCE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")
SECRET = re.compile(r"(?i)(password|secret|token|api_?key|credential|webhook_url|jdbc_url)")
SOURCE_TYPES = {
    "website": [("sitemap_url", "sitemap_urls")],
    "webdriver": [("url", "start_url", "start_urls")],
    "jira-service-management": [("url", "start_url", "start_urls")],
    "local": [("path", "paths", "root")],
    "s3": [("bucket",)],
    "gcs": [("bucket",)],
}
MODES = ("auto", "html", "detect", "configured")
PROVIDERS = {"noop": (), "hash": (), "openai": ("model", "api_key"), "azure-openai": ("endpoint", "deployment", "api_key"), "vertex-ai": ("model", "project", "location")}
INDEX_KEYS = {"name", "auto_activate", "languages", "embedding", "chunking", "sources"}
CHUNKING_KEYS = {"max_tokens", "max_input_tokens", "safety_multiplier"}


class ConfigError(ValueError):
    pass


def interpolate(value, env: dict[str, str] | None = None):
    """Every ${NAME} in strings from the environment; a missing one is an error."""
    env = os.environ if env is None else env
    if isinstance(value, dict):
        return {k: interpolate(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [interpolate(v, env) for v in value]
    if isinstance(value, str):
        missing = [n for n in REFERENCE.findall(value) if n not in env]
        if missing:
            raise ConfigError(f"missing environment variables: {', '.join(missing)}")
        return REFERENCE.sub(lambda m: env[m[1]], value)
    return value


def redact(value):
    """Values of secret keys hidden, at any depth."""
    if isinstance(value, dict):
        return {k: "***" if SECRET.search(str(k)) and v is not None else redact(v) for k, v in value.items()}
    return [redact(v) for v in value] if isinstance(value, list) else value


def structural_hash(raw: dict) -> str:
    """Hash of the redacted configuration before interpolation, whatever the order of keys."""
    return hashlib.sha256(json.dumps(redact(raw), sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def duration(text: str) -> timedelta:
    """ISO 8601 durations (P30D, PT12H) or a number with d, h, m or s."""
    if m := re.fullmatch(r"(\d+)\s*([dhms])", text.strip().lower()):
        return timedelta(**{{"d": "days", "h": "hours", "m": "minutes", "s": "seconds"}[m[2]]: int(m[1])})
    if (m := re.fullmatch(r"P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?", text.strip().upper())) and any(m.groups()):
        w, d, h, mi, s = (float(x or 0) for x in m.groups())
        return timedelta(weeks=w, days=d, hours=h, minutes=mi, seconds=s)
    raise ConfigError(f"not a duration: {text}")


def require(ok, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def positive(config: dict, where: str, *keys: str, least: float = 0, strict: bool = True) -> None:
    for key in keys:
        if (v := config.get(key)) is not None:
            require(isinstance(v, (int, float)) and not isinstance(v, bool) and (v > least if strict else v >= least), f"{where}.{key} must be {'over' if strict else 'at least'} {least}")


def tag(locale: str) -> str:
    return re.split(r"[-_]", str(locale))[0].lower()


def check_languages(index: dict, source: dict | None = None) -> None:
    """Fallback and configured locale are allowed ones; a source allows only what its index allows."""
    index_allowed = {tag(x) for x in (index.get("languages") or {}).get("allowed") or ()}
    own = (source or {}).get("language") or {} if source else index.get("languages") or {}
    where = f"source {source.get('id')}" if source else f"index {index.get('name')}"
    allowed = {tag(x) for x in own.get("allowed") or ()} or index_allowed
    require(all(re.fullmatch(r"[a-z]{2,3}", x) for x in allowed), f"{where}: unknown locale")
    if source and index_allowed:
        require(allowed <= index_allowed, f"{where}: allows languages its index doesn't")
    for key in ("fallback", "locale"):
        if own.get(key) is not None and allowed:
            require(tag(own[key]) in allowed, f"{where}: {key} isn't allowed")
    mode = str(own.get("mode") or "auto").lower()
    require(mode in MODES, f"{where}: unknown language mode {mode}")
    if mode == "configured":
        require(own.get("locale"), f"{where}: mode configured needs a locale")


def check_source(index: dict, source: dict) -> None:
    kind, where = source.get("type"), f"source {source.get('id')}"
    require(source.get("id"), "a source needs an id")
    require(kind in SOURCE_TYPES, f"{where}: unknown type {kind}")
    for group in SOURCE_TYPES[kind]:
        require(any(source.get(k) for k in group), f"{where}: needs one of {', '.join(group)}")
    positive(source, where, "max_pages", "max_concurrency", "api_page_limit", "request_max_retries", "request_retry_initial_ms", "request_retry_max_delay_ms", "max_sitemap_depth", "request_timeout_ms")
    positive(source, where, "inter_request_delay_ms", "request_retry_jitter_ms", "browser_restart_after_pages", "browser_restart_after_failures", strict=False)
    check_languages(index, source)


def check_thresholds(limits: dict) -> None:
    positive(limits, "thresholds", "max_removed_absolute", strict=False)
    for key, value in limits.items():
        if key.endswith("_percentage") and value is not None:
            require(0 <= value <= 1, f"thresholds.{key} must be between 0 and 1")


def check(config: dict) -> dict:
    """config itself, if it is sound."""
    indexes = config.get("indexes") or []
    require(indexes, "no indexes")
    names = [i.get("name") for i in indexes]
    require(all(names) and len(set(names)) == len(names), "indexes need unique names")
    for index in indexes:
        require(set(index) <= INDEX_KEYS, f"index {index['name']}: unknown keys {sorted(set(index) - INDEX_KEYS)}")
        embedding, chunking = index.get("embedding") or {}, index.get("chunking") or {}
        provider = embedding.get("provider", "noop")
        require(provider in PROVIDERS, f"unknown embedding provider {provider}")
        for key in PROVIDERS[provider]:
            require(embedding.get(key), f"embedding provider {provider} needs {key}")
        require(isinstance(embedding.get("embedding_dimensions"), int) and embedding["embedding_dimensions"] > 0, "embedding_dimensions must be a positive number")
        positive(embedding, "embedding", "max_batch_size", "max_retries", "request_timeout_ms")
        positive(embedding, "embedding", "retry_initial_ms", "retry_jitter_ms", "inter_batch_delay_ms", strict=False)
        require(set(chunking) <= CHUNKING_KEYS, "unknown chunking keys")
        positive(chunking, "chunking", *CHUNKING_KEYS)
        if {"max_tokens", "max_input_tokens"} <= set(chunking):
            require(chunking["max_tokens"] * chunking.get("safety_multiplier", 1) <= chunking["max_input_tokens"], "chunking: max_tokens with its safety goes beyond max_input_tokens")
        check_languages(index)
        ids = [s.get("id") for s in index.get("sources") or ()]
        require(ids and len(set(ids)) == len(ids), f"index {index['name']}: sources need unique ids")
        for source in index["sources"]:
            check_source(index, source)
    verification = config.get("verification") or {}
    check_thresholds(verification.get("deterministic_thresholds") or {})
    positive(verification, "verification", "max_prompt_tokens", "max_retries", "request_timeout_ms", "max_output_tokens")
    require(not (verification.get("temperature") is not None and verification.get("top_p") is not None), "verification: temperature or top_p, not both")
    for key, top in (("temperature", 2), ("top_p", 1)):
        if verification.get(key) is not None:
            require(0 <= verification[key] <= top, f"verification.{key} must be between 0 and {top}")
    attestors = (verification.get("attestations") or {}).get("trusted")
    if attestors is not None:
        require(attestors and all(str(a).strip() for a in attestors) and len(set(attestors)) == len(attestors), "trusted attestors must be named once each")
    if (age := (config.get("retention") or {}).get("max_age_days")) is not None:
        require(age > 0, "retention.max_age_days must be over 0")
    return config


def load(path: str, env: dict[str, str] | None = None) -> tuple[dict, str]:
    """(checked configuration, structural hash) of a YAML or JSON file."""
    text = open(path, encoding="utf-8").read()
    try:
        import yaml

        raw = yaml.safe_load(text)
    except ImportError:
        raw = json.loads(text)
    require(isinstance(raw, dict), "the configuration must be a mapping")
    return check(interpolate(raw, env)), structural_hash(raw)


def selected(config: dict, name: str | None = None) -> list[dict]:
    found = [i for i in config["indexes"] if name is None or i["name"] == name]
    require(found, f"no index named {name}")
    return found
