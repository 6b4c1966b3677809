"""Token estimates and sentence pieces."""

from __future__ import annotations

import math
import re
from bisect import bisect_left

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOT_WORD = re.compile(r"[\W_]+")
_PUNCTUATION = re.compile(r"[^\w\s]|_")
_SENTENCE = re.compile(r"(?<=[.!?])\s+", re.ASCII)


#: The most letters of a word of one, two and three tokens, the letters of a token beyond, the factors for
#: punctuation, for signs beyond ASCII and for safety, and the characters of a token where text is cut.
STEPS, LETTERS, MARKED, WIDE, SAFETY, CHARACTERS = (4, 8, 12), 4, 1.2, 1.1, 1.3, 3.5


def word_cost(size: Column) -> Column:
    """Tokens of a word by its length."""
    cost = F.ceil(size / F.lit(float(LETTERS)))
    for tokens, most in reversed(list(enumerate(STEPS, 1))):
        cost = F.when(size <= most, tokens).otherwise(cost)
    return cost.cast("int")


def estimate(value: Column) -> Column:
    """Estimated tokens: word costs, a fifth more with punctuation, a tenth more beyond ASCII, 30 % for safety; at
    least 1."""
    text = F.coalesce(value, F.lit(""))
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    base = F.aggregate(words, F.lit(0), lambda total, w: total + word_cost(F.length(w)))
    wider = F.when(text.rlike(r"[^\p{L}\p{N}\s]"), base * F.lit(MARKED)).otherwise(base.cast("double"))
    wider = F.when(text.rlike(r"[^\x00-\x7F]"), wider * F.lit(WIDE)).otherwise(wider)
    return F.greatest(F.lit(1), F.ceil(wider * F.lit(SAFETY)).cast("int"))


def sentences(value: Column) -> Column:
    """Trimmed non-blank sentences: cut at white space after a full stop, exclamation or question mark."""
    parts = F.split(F.coalesce(value, F.lit("")), r"(?<=[.!?])\s+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def cost_parts(text: str) -> tuple[int, bool, bool]:
    """(word costs, has punctuation, goes beyond ASCII): sums and ORs of these over parts give the parts' whole."""
    base = sum(bisect_left(STEPS, n) + 1 if n <= STEPS[-1] else math.ceil(n / LETTERS) for n in map(len, filter(None, _NOT_WORD.split(text))))
    return base, _PUNCTUATION.search(text) is not None, not text.isascii()


def total(base: int, marks: bool, wide: bool) -> int:
    value: float = base * MARKED if marks else base
    if wide:
        value *= WIDE
    return max(1, math.ceil(value * SAFETY))


def estimate_one(text: str) -> int:
    return total(*cost_parts(text))


def sentence_list(text: str) -> list[str]:
    return [s for s in (p.strip() for p in _SENTENCE.split(text)) if s]


def slices_of(text: str, width: int) -> list[str]:
    """The non-blank slices of a width."""
    return [s for s in (text[i : i + width].strip() for i in range(0, len(text), width)) if s]


def slice_width(text: str, budget: int) -> int:
    """The first width of those halved from the budget's characters whose slices all keep within it; 1 always does, as
    the width has to depend on the budget alone where results of equal texts are compared."""
    widths = [max(1, int(budget * CHARACTERS))]
    while widths[-1] > 1:
        widths.append(widths[-1] // 2)
    return next((w for w in widths if all(estimate_one(s) <= budget for s in slices_of(text, w))), 1)


def fixed_slices(text: str, budget: int) -> list[str]:
    """Slices of equal width within the budget."""
    return slices_of(text, slice_width(text, budget))


def pieces(text: str, budget: int) -> list[str]:
    """Sentences; those over the budget in slices."""
    return [p for s in sentence_list(text) for p in ([s] if estimate_one(s) <= budget else fixed_slices(s, budget))]
