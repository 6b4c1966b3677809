"""Embedding providers, their fingerprint, and the distributed embedding of missing content."""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from siltstone.sources.retry import with_retries

MAX_BATCH = 96
SPACE_KEYS = ("provider", "model", "dimensions", "deployment", "api_version", "task_type", "location", "endpoint")


class Embedder(Protocol):
    def __call__(self, texts: list[str]) -> list[list[float]]: ...


class NoEmbedder:
    """Zero vectors; runs made with it are never activated."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> list[list[float]]:
        return [[0.0] * self.dimensions for _ in texts]


class HashEmbedder:
    """Unit vectors from hashed words: the same text always has the same vector, near texts have near ones."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            vector = [0.0] * self.dimensions
            for word in text.lower().split():
                digest = hashlib.blake2b(word.encode(), digest_size=8).digest()
                vector[int.from_bytes(digest[:4], "big") % self.dimensions] += 1.0 if digest[4] & 1 else -1.0
            norm = math.sqrt(sum(x * x for x in vector)) or 1.0
            out.append([x / norm for x in vector])
        return out


class HttpEmbedder:
    """A provider behind an injected transport: request(payload) -> response. Shapes of the three kinds of service are
    told apart by `kind`; entries are put in the order of their index."""

    def __init__(self, kind: str, model: str, request: Callable[[dict], dict], dimensions: int | None = None):
        if kind not in ("openai", "azure-openai", "vertex-ai"):
            raise ValueError(f"unknown provider {kind}")
        self.kind, self.model, self.request, self.dimensions = kind, model, request, dimensions

    def __call__(self, texts: list[str]) -> list[list[float]]:
        if self.kind == "vertex-ai":
            payload = {"instances": [{"content": t} for t in texts]} | ({"parameters": {"outputDimensionality": self.dimensions}} if self.dimensions else {})
            return [p["embeddings"]["values"] for p in self.request(payload)["predictions"]]
        payload = {"input": texts} | ({"model": self.model} if self.kind == "openai" else {}) | ({"dimensions": self.dimensions} if self.dimensions else {})
        return [d["embedding"] for d in sorted(self.request(payload)["data"], key=lambda d: d["index"])]


def fingerprint(config: dict) -> str:
    """Hash of what makes two embedding spaces the same."""
    chosen = {k: config[k] for k in SPACE_KEYS if config.get(k) is not None}
    return hashlib.sha256(json.dumps(chosen, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def embedded(missing: DataFrame, embedder: Embedder, text: str = "content", size: int = MAX_BATCH, attempts: int = 3, sleep: Callable[[float], None] | None = None, delay: float = 0.0, **waits: float) -> DataFrame:
    """(content_hash, embedding) of (content_hash, text), in batches of at most `size` texts, `delay` seconds apart, retried
    inside the task.
    A provider that returns another number of vectors than it got texts fails the job."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in parts:
            vectors: list[list[float]] = []
            for at in range(0, len(frame), size):
                texts = frame[text].iloc[at : at + size].tolist()
                if delay and at:
                    (sleep or time.sleep)(delay)
                found = with_retries(lambda texts=texts: embedder(texts), attempts, sleep=sleep, **waits)
                if len(found) != len(texts):
                    raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
                vectors += found
            yield pd.DataFrame({"content_hash": frame["content_hash"], "embedding": vectors})

    return missing.select("content_hash", text).dropDuplicates(["content_hash"]).mapInPandas(run, "content_hash string, embedding array<float>")
