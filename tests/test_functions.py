import pytest
from pyspark.sql import functions as F

from siltstone.functions import globs, text, tokens, urls, vectors


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<float>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("fold", [True, False])
def test_normalize_text(spark, fold):
    assert one(spark, text.normalize_text(F.col("t"), fold), t="  a​’b\n\u0007 “c” ") == "a'b \"c\""
    assert one(spark, text.normalize_text(F.col("t"), fold), t=None) is None


def test_nfkc_and_driver_form_agree(spark):
    value = "ﬁ ﾊﾝ①  ﻿x"
    assert one(spark, text.normalize_text(F.col("t")), t=value) == text.clean(value) == "fi ハン1 x"


def test_hash_of_null_and_text(spark):
    assert one(spark, text.content_hash(F.col("t")), t="hello") == "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    assert one(spark, text.content_hash(F.col("t")), t=None) == one(spark, text.content_hash(F.col("t")), t="")


def test_text_forms(spark):
    assert one(spark, text.shortened(F.col("t"), 5), t="abcdefgh") == "ab..."
    assert one(spark, text.paragraphs(F.col("t")), t="a\nb\n \n\n c ") == ["a b", "c"]
    assert one(spark, text.extension(F.col("t")), t="x/y.tar.GZ") == "gz"
    assert one(spark, text.locale_subtag(F.col("t")), t="PT_br") == "pt"
    assert one(spark, text.locale_of_file(F.col("t"), r"_([a-z]{2})\.json$", {"xx": "de"}), t="a/b_xx.json") == "de"
    assert one(spark, text.is_meaningful(F.col("t"), 3), t=" ab ") is False


@pytest.mark.parametrize("value", ["", "abcd", "abcde", "word, word", "naïve", "x" * 100, "a b c d e f g", "!!!"])
def test_estimates_agree_in_both_forms(spark, value):
    assert one(spark, tokens.estimate(F.col("t")), t=value) == tokens.estimate_one(value)


def test_pieces_keep_within_the_budget():
    parts = tokens.pieces("Short one. " + "x" * 100 + "! Next?", 5)
    assert parts[0] == "Short one." and parts[-1] == "Next?"
    assert all(tokens.estimate_one(p) <= 5 for p in parts)
    assert "".join(parts).replace(" ", "") == "Shortone." + "x" * 100 + "!Next?"


@pytest.mark.parametrize(
    "base, href, want",
    [("https://a.b/c/d", "../e?x=1#f", "https://a.b/e?x=1"), ("https://a.b/c/", "./x/../y", "https://a.b/c/y"), ("https://a.b", "mailto:q@r", "mailto:q@r"), (None, "x", None), ("https://a.b/", None, None)],
)
def test_resolve(base, href, want):
    assert urls.resolve(base, href) == want


def test_url_columns(spark):
    assert one(spark, urls.host(F.col("u")), u="https://Docs.X.org:8443/a") == "docs.x.org"
    assert one(spark, urls.origin(F.col("u")), u="https://me:pw@Docs.X.org:8443/a") == "https://Docs.X.org:8443"
    assert one(spark, urls.web_host(F.col("u")), u="file:///a") is None
    assert one(spark, urls.host(F.col("u")), u="not a url %%") is None
    assert one(spark, urls.article_id(F.col("u")), u="https://x/wiki/spaces/AB/pages/123/t") == "123"
    assert one(spark, urls.article_id(F.col("u")), u="https://x/pages/resumedraft.action") is None
    assert one(spark, urls.segment_after(F.col("u"), "topic"), u="https://x/topic/ab-1?q") == "ab-1"
    assert one(spark, urls.reportable(F.col("u")), u="https://me:pw@x/a?token=1#f") == "https://x/a"
    assert one(spark, urls.preference_score(F.col("u"), ["en", "docs", "zz"]), u="https://x/docs/en") == 2


def test_allowed(spark):
    rule = urls.allowed(F.col("u"), ["https://a/"], ["https://a/no"], ["https://a/private/"])
    assert [one(spark, rule, u=u) for u in ("https://a/x", "https://b/x", "https://a/no", "https://a/private/1", "", None)] == [True, False, False, False, False, False]
    assert urls.is_allowed("https://a/x", ["https://a/"], ["https://a/no"]) and not urls.is_allowed("https://a/no", ["https://a/"], ["https://a/no"])


@pytest.mark.parametrize(
    "glob, path, want",
    [("**/*.md", "a.md", True), ("**/*.md", "x/y/a.md", True), ("*.md", "x/a.md", False), ("docs/?.txt", "docs/a.txt", True), ("docs/?.txt", "docs/ab.txt", False), ("a+b/**", "a+b/c/d", True)],
)
def test_globs(spark, glob, path, want):
    assert one(spark, globs.matches(F.col("p"), [glob]), p=path) is want


def test_included(spark):
    rule = globs.included(F.col("p"), ["**/*.md"], ["**/private*"])
    assert [one(spark, rule, p=p) for p in ("a.md", "x/private.md", "a.txt")] == [True, False, False]


def test_cosine(spark):
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=[1.0, 0.0], b=[2.0, 0.0]) == pytest.approx(1.0)
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=[0.0, 0.0], b=[2.0, 0.0]) is None
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=[1.0], b=[2.0, 0.0]) is None
    assert one(spark, vectors.of_size(F.col("a"), 2), a=[1.0, 0.0]) is True


def test_languages_by_words_and_by_script(spark):
    from pyspark.sql import functions as F

    from siltstone.operators.language_choice import detected

    rows = {
        "de": "Das Haus steht an dem Fluss und kann auch von der Stadt aus gesehen werden.", "nl": "Het huis kan ook van de stad door de mensen gezien worden.",
        "pt": "A casa foi vista pelo homem ou por sua mãe à noite.", "ru": "Дом стоит у реки.", "el": "Το σπίτι είναι κοντά.", "ja": "これはペンです。", "zh": "河边有房子。", None: "12 34",
    }
    frame = spark.createDataFrame([(k, v) for k, v in rows.items()], "want string, text string")
    found = frame.select("want", detected(F.col("text"), ["de", "nl", "pt", "ru", "el", "ja", "zh", "xx"])["locale"].alias("got")).collect()
    assert {r["want"]: r["got"] for r in found} == {k: k for k in rows}
