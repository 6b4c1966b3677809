"""Text column functions. NFKC has no built-in and is an Arrow UDF; everything else is a Catalyst expression."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Curly quotes and their straight forms, position by position.
CURLY = "‘’‚‛“”„‟"
STRAIGHT = "''''\"\"\"\""
_ZERO_WIDTH = re.compile("[\u200b\u200c\u200d\ufeff]")
_CONTROL = re.compile("[\x00-\x1f\x7f]")
_SPACE = re.compile(r"\s+", re.ASCII)
_TO_STRAIGHT = str.maketrans(CURLY, STRAIGHT)


def clean(value: str | None) -> str | None:
    """One string normalised: NFKC, no zero-width signs, control signs as spaces, straight quotes, single spaces."""
    if value is None:
        return None
    folded = _CONTROL.sub(" ", _ZERO_WIDTH.sub("", unicodedata.normalize("NFKC", value)))
    return _SPACE.sub(" ", folded.translate(_TO_STRAIGHT)).strip(" ")


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v), na_action="ignore")


def normalize_text(value: Column, fold: bool = True) -> Column:
    """Normalised text; null stays null. fold=False leaves NFKC out for input known to be folded, with no Python."""
    folded = nfkc(value) if fold else value
    visible = F.regexp_replace(folded, "[\\u200B\\u200C\\u200D\\uFEFF]", "")
    plain = F.translate(F.regexp_replace(visible, "[\\x00-\\x1f\\x7f]", " "), CURLY, STRAIGHT)
    return F.trim(F.regexp_replace(plain, "\\s+", " "))


def content_hash(value: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the UTF-8 bytes; null counts as the empty string."""
    return F.sha2(F.coalesce(value, F.lit("")), 256)


def is_meaningful(value: Column, least: int, fold: bool = True) -> Column:
    return F.length(F.coalesce(normalize_text(value, fold), F.lit(""))) >= least


def without_phrases(value: Column, phrases: list[str]) -> Column:
    """Each phrase, taken literally, replaced by a space."""
    for phrase in phrases:
        value = F.replace(value, F.lit(phrase), F.lit(" "))
    return value


def shortened(value: Column, limit: int, mark: str = "...") -> Column:
    """At most `limit` characters, the mark included."""
    return F.when(F.length(value) > limit, F.concat(F.substring(value, 1, max(0, limit - len(mark))), F.lit(mark))).otherwise(value)


def markup_escaped(value: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(sign), F.lit(name))
    return value


def link_text_escaped(value: Column) -> Column:
    return F.regexp_replace(value, r"([\\\[\]])", r"\\$1")


def paragraphs(value: Column) -> Column:
    """Non-blank paragraphs between blank lines, with single spaces."""
    parts = F.split(F.coalesce(value, F.lit("")), r"\n\s*\n")
    return F.filter(F.transform(parts, lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), lambda p: p != "")


def segments(value: Column) -> Column:
    """Trimmed non-blank lines."""
    return F.filter(F.transform(F.split(F.coalesce(value, F.lit("")), r"\r\n|\n|\r"), lambda s: F.trim(s)), lambda s: s != "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """The lower-case ending after the last dot of the file name, null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(base_name(path), r"\.([^.]+)$", 1)), F.lit(""))


def locale_subtag(locale: Column) -> Column:
    """The first subtag of a locale in lower case, null where it is empty."""
    return F.nullif(F.lower(F.split(F.replace(locale, F.lit("_"), F.lit("-")), "-")[0]), F.lit(""))


def readiness_text(value: Column) -> Column:
    """Lower case with single spaces, for comparing rendered states of a page."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), r"\s+", " "))


def locale_of_file(path: Column, pattern: str, mapping: dict[str, str]) -> Column:
    """The locale that a pattern's first group (or whole match) of the file name maps to, else null."""
    group = 1 if re.compile(pattern).groups else 0
    token = F.regexp_extract(base_name(F.coalesce(path, F.lit(""))), pattern, group)
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[token] if mapping else F.lit(None).cast("string")
