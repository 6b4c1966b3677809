"""The language of a document: configured, from its page, detected, or a fallback.

The detector scores function words of the allowed languages inside the JVM; it needs no model and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import locale_subtag

#: Function words by which a text's language is scored.
MARKERS = {
    "de": "der die das und ist nicht sie wenn von zu mit ein für auf den dem wird auch nach bei sich oder aus eine einen noch nur kann",
    "en": "the to is and of you that with it not for has are this be from have was or by an can which their will more when if",
    "es": "el los las que no se del una para con y más su por al como está pero cuando este lo sus le ya si fue ser entre",
    "fr": "le les des et est pas que une pour dans du qui sur vous ne au par plus ce avec il sont ou cette être aux mais sa",
    "it": "il gli che non è di una per con si della lo del nel alla più sono come dei le questo ha da anche se nella dal sul",
    "nl": "het een van en niet zijn wordt naar voor dat met op te aan als bij ook er om maar deze of worden kan dan nog door hun",
    "pt": "os não que uma para do da com em é ao as dos das no na mais se por como foi seu um à sua ou ser pelo",
}
#: Languages told by their script: so many letters of it count as a word. They take part where they are allowed by name.
SCRIPTS = {"ar": r"\p{IsArabic}", "el": r"\p{IsGreek}", "he": r"\p{IsHebrew}", "hi": r"\p{IsDevanagari}", "ja": r"[\p{IsHiragana}\p{IsKatakana}]", "ko": r"\p{IsHangul}", "ru": r"\p{IsCyrillic}", "th": r"\p{IsThai}", "zh": r"\p{IsHan}"}
SCRIPT_LETTERS = 3


def detected(text: Column, allowed: list[str] | None = None) -> Column:
    """struct(locale, source, confidence) or null: the allowed language with most marker words, with its share of all
    languages' marker words as confidence. One allowed language is taken without looking; languages that have neither
    marker words nor a script of their own are never detected."""
    has_text = F.coalesce(F.length(F.trim(text)) > 0, F.lit(False))
    if allowed and len(allowed) == 1:
        return F.when(has_text, F.struct(F.lit(allowed[0]).alias("locale"), F.lit("configured").alias("source"), F.lit(1.0).alias("confidence")))
    chosen = {k: v for k, v in MARKERS.items() if not allowed or k in allowed}
    scripts = {k: v for k, v in SCRIPTS.items() if k in (allowed or ())}
    if not chosen and not scripts:
        return F.lit(None).cast("struct<locale:string,source:string,confidence:double>")
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = [F.struct(F.regexp_count(low, F.lit(_any_of(v))).alias("n"), F.lit(k).alias("locale")) for k, v in sorted(chosen.items(), reverse=True)]
    hits += [F.struct((F.regexp_count(low, F.lit(v)) / SCRIPT_LETTERS).cast("int").alias("n"), F.lit(k).alias("locale")) for k, v in sorted(scripts.items(), reverse=True)]

    def of(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0), lambda a, h: a + h["n"])
        told = F.transform(F.array(F.array_max(counts)), lambda b: F.when(b["n"] > 0, F.struct(b["locale"].alias("locale"), F.lit("detected").alias("source"), (b["n"] / total).alias("confidence"))))
        return told[0]

    # the counts are bound once by the outer transform, however often they are used
    return F.when(has_text, F.transform(F.array(F.array(*hits)), of)[0])


def _any_of(markers: str) -> str:
    return r"(?<!\p{L})(?:" + "|".join(sorted(markers.split(), key=len, reverse=True)) + r")(?!\p{L})"


def language(html_locale: Column, text: Column, mode: str = "auto", locale: str | None = None, allowed: list[str] | None = None, fallback: str | None = None) -> Column:
    """struct(locale, source, confidence): the first of the configured locale (mode configured), the page's (auto and
    html), the detected one (auto and detect) and the fallback that is allowed; else unknown."""
    mode = (mode or "auto").lower()

    def given(value: Column, source: str, confidence: float | None):
        tag = locale_subtag(value)
        ok = tag.isNotNull() & (tag.isin(*allowed) if allowed else F.lit(True))
        return F.when(ok, F.struct(tag.alias("locale"), F.lit(source).alias("source"), F.lit(confidence).cast("double").alias("confidence")))

    none = F.lit(None).cast("string")
    options = []
    if mode == "configured":
        options.append(given(F.lit(locale) if locale else none, "configured", 1.0))
    if mode in ("auto", "html"):
        options.append(given(html_locale, "html", 1.0))
    if mode in ("auto", "detect"):
        options.append(detected(text, allowed))
    options.append(given(F.lit(fallback) if fallback else none, "fallback", None))
    unknown = F.struct(none.alias("locale"), F.lit("unknown").alias("source"), F.lit(None).cast("double").alias("confidence"))
    return F.coalesce(*options, unknown)


def annotated(documents: DataFrame, **config) -> DataFrame:
    found = language(F.col("html_locale"), F.col("normalized_content"), **config)
    return documents.withColumn("l", found).withColumns({"locale": F.col("l.locale"), "language_source": F.col("l.source"), "language_confidence": F.col("l.confidence")}).drop("l")
