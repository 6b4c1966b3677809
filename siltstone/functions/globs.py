"""Path patterns: ** over folders, * and ? inside a name; **/ also stands for no folder."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_regex(glob: str) -> str:
    out, i = [], 0
    while i < len(glob):
        if glob.startswith("**/", i):
            out.append("(?:.*/)?")
            i += 3
        elif glob.startswith("**", i):
            out.append(".*")
            i += 2
        else:
            out.append({"*": "[^/]*", "?": "[^/]"}.get(glob[i], re.escape(glob[i])))
            i += 1
    return "^" + "".join(out) + "$"


def matches(path: Column, globs: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [path.rlike(to_regex(g)) for g in globs], F.lit(False))


def included(path: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Matches one of include (if there are any) and none of exclude."""
    wanted = matches(path, include) if include else F.lit(True)
    return wanted & ~matches(path, exclude or [])
