"""Run reports and notices."""

from __future__ import annotations

import json
from collections.abc import Callable

SIGNS = {"pass": "OK", "caution": "CHECK", "fail": "STOP"}
SECTION_LIMIT, URL_LIMIT = 2800, 110


def escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def cut(text: str, limit: int, mark: str = "...") -> str:
    return text if len(text) <= limit else text[: max(0, limit - len(mark))] + mark


def summary_line(run: dict) -> str:
    counts = run.get("diff", {})
    changes = ", ".join(f"{counts.get(f'{c}_count', 0)} {c}" for c in ("added", "removed", "changed", "moved"))
    return f"[{SIGNS.get(run.get('verdict'), '?')}] {run['index_name']}: {run.get('document_count', 0)} documents, {run.get('chunk_count', 0)} chunks; {changes}; {run.get('action', 'hold')}"


def source_line(source: dict) -> str:
    failed = f", {source['error_count']} failed" if source.get("error_count") else ""
    return f"- {source['source_id']}: {source['document_count']} documents{failed}, {source.get('skipped_count', 0)} skipped"


def change_lines(changes: list[dict], hidden: int = 0) -> list[str]:
    lines = [f"{c['change_type']}: {escaped(cut((c.get('previous_url') or '') + ' to ' * bool(c.get('previous_url')) + c['canonical_url'], URL_LIMIT))}" for c in changes]
    return [*lines, f"... and {hidden} more"] if hidden else lines


def full_report(run: dict, sources: list[dict], changes: list[dict], hidden: int = 0) -> str:
    parts = [summary_line(run), "", "Sources", *map(source_line, sources)]
    if run.get("findings"):
        parts += ["", "Gate", *[f"- {f['check']}: {f['verdict']} ({f['actual']:g} over {f['threshold']:g})" for f in run["findings"]]]
    if run.get("reasoning"):
        parts += ["", "Verifier", run["reasoning"]]
    if changes:
        parts += ["", "Changes", *change_lines(changes, hidden)]
    if run.get("timings"):
        parts += ["", "Timings", *[f"- {k}: {v:.0f} ms" for k, v in run["timings"].items()]]
    return "\n".join(parts)


def message(run: dict, sources: list[dict], changes: list[dict], hidden: int = 0) -> dict:
    sections = [summary_line(run), "\n".join(map(source_line, sources)), "\n".join(change_lines(changes, hidden))]
    return {"text": summary_line(run), "sections": [cut(s, SECTION_LIMIT) for s in sections if s]}


def notify(post: Callable[[str, str], int] | None, url: str | None, payload: dict) -> dict:
    """skipped, sent or failed; never raises."""
    if not url or post is None:
        return {"status": "skipped"}
    try:
        status = post(url, json.dumps(payload))
    except Exception as problem:  # noqa: BLE001 - a notice must not fail a run
        return {"status": "failed", "message": str(problem)}
    return {"status": "sent" if 200 <= status < 300 else "failed", "http_status": status}
