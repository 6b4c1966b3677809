"""Chunks within a token budget that keep to sections."""

from __future__ import annotations

import hashlib

from siltstone.functions.tokens import cost_parts, estimate_one, pieces, sentence_list, total

DEFAULT_BUDGET = 6550


def context_of(block: dict) -> str | None:
    """The heading path as a prefix; headings have none."""
    return " > ".join(block["heading_path"]) if block["type"] != "heading" and block["heading_path"] else None


def opened(block: dict, part: str, budget: int) -> str:
    """A part at the start of a chunk, with its heading context if that fits."""
    context = context_of(block)
    if context is None:
        return part
    prefixed = f"{context}\n{part}"
    return prefixed if estimate_one(prefixed) <= budget else part


def parts_of(block: dict, budget: int) -> list[str]:
    """The block's sentences, cut so that each can start a chunk with its context."""
    context = context_of(block)
    if context is None or estimate_one(context) >= budget:
        return pieces(block["text"], budget)
    whole = sentence_list(block["text"])
    sizes = list(map(estimate_one, whole))
    width = max(1, budget - estimate_one(context))
    while True:
        found = pieces(block["text"], width)
        bad = [p for p in found if estimate_one(f"{context}\n{p}") > budget and not (opened(block, p, budget) == p and estimate_one(p) <= budget)]
        if width == 1 or not bad:
            return found
        # as long as no sentence is cut, nothing changes before the width is below the largest that doesn't fit
        width = max(1, min(width, max(map(estimate_one, bad))) - 1) if max(sizes, default=0) <= width else width - 1


def chunks_of(blocks: list[dict], budget: int | None = None) -> list[dict]:
    """Greedy packing of sentences, joined by blank lines. Word costs add up over parts and the two surcharges are ORs,
    so the estimate of a growing chunk is kept as three numbers instead of being counted again. A chunk has the
    heading path of its last part."""
    budget = budget or DEFAULT_BUDGET
    done: list[tuple[list[str], list[str]]] = []
    held: list[str] = []
    base, marks, wide = 0, False, False
    path: list[str] = []
    for block in blocks:
        for part in parts_of(block, budget):
            if held:
                b, m, w = cost_parts(part)
                if total(base + b, marks or m, wide or w) <= budget:
                    held.append(part)
                    base, marks, wide = base + b, marks or m, wide or w
                    path = block["heading_path"]
                    continue
                done.append((held, path))
            first = opened(block, part, budget)
            held = [first]
            base, marks, wide = cost_parts(first)
            path = block["heading_path"]
    if held:
        done.append((held, path))
    out = []
    for i, (parts, where) in enumerate(done):
        content = "\n\n".join(parts)
        out.append({"chunk_index": i, "chunk_count": len(done), "content": content, "content_hash": hashlib.sha256(content.encode()).hexdigest(), "estimated_tokens": estimate_one(content), "heading_path": list(where)})
    return out
