"""Retries of requests and the outcome of their failures."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

#: Defaults: attempts (the first one included), first wait, most jitter and longest wait in seconds.
ATTEMPTS, FIRST_WAIT, JITTER, LONGEST_WAIT = 3, 1.0, 0.25, 60.0
MAX_ERROR_BODY = 1024


class RequestFailed(RuntimeError):
    def __init__(self, status: int | None, message: str = "", retry_after: str | None = None):
        super().__init__(message or f"status {status}")
        self.status, self.retry_after = status, retry_after


def is_retryable(problem: Exception) -> bool:
    """Too many requests, server errors and broken connections; other 4xx never are."""
    if isinstance(problem, RequestFailed):
        return problem.status is None or problem.status == 429 or problem.status >= 500
    return isinstance(problem, (OSError, TimeoutError))


def seconds_after(header: str | None, now: datetime | None = None) -> float:
    """The wait a Retry-After header asks for: seconds or a date; 0 for what can't be read."""
    if not header:
        return 0.0
    header = header.strip()
    if re.fullmatch(r"\d{1,15}", header):
        return float(header)
    try:
        at = parsedate_to_datetime(header)
    except (ValueError, TypeError):
        return 0.0
    at = at if at.tzinfo else at.replace(tzinfo=UTC)
    return max(0.0, (at - (now or datetime.now(UTC))).total_seconds())


def with_retries(call: Callable, attempts: int = ATTEMPTS, first: float = FIRST_WAIT, jitter: float = JITTER, longest: float = LONGEST_WAIT, sleep: Callable[[float], None] | None = None, draw: Callable[[], float] = random.random):
    """call() again until it succeeds, fails for good or the attempts are used up. The wait doubles, is at least what
    the server asks for, has jitter and stays below the longest."""
    wait = first
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception as problem:
            if attempt == attempts or not is_retryable(problem):
                raise
            asked = seconds_after(getattr(problem, "retry_after", None))
            (sleep or time.sleep)(min(longest, max(wait, asked) + draw() * jitter))
            wait *= 2


def category(status: int | None) -> str:
    if status is None:
        return "unavailable"
    named = {401: "forbidden", 403: "forbidden", 404: "not-found", 410: "not-found", 409: "conflict", 429: "busy", 503: "unavailable"}
    return named.get(status, "fault" if status >= 500 else "incorrect" if status >= 400 else "ok")


def failure(problem: Exception) -> dict:
    """An anomaly's fields; long messages are cut."""
    text = str(problem)
    status = getattr(problem, "status", None)
    return {"category": category(status) if isinstance(problem, RequestFailed) else "fault", "type": type(problem).__name__, "message": text if len(text) <= MAX_ERROR_BODY else text[:MAX_ERROR_BODY] + "...", "status": status}
