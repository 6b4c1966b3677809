import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.operators.chunking import chunks_of
from siltstone.operators.html_blocks import atx_heading, extract, extract_html, extract_json, markdown_blocks, parse, select
from siltstone.operators.pipeline import chunks, documents, source_counts


def texts(found):
    return [(b["type"], b["text"], b["heading_path"]) for b in found["blocks"]]


def test_blocks_paths_and_removed_parts():
    page = """<html lang="en-GB"><head><title> T &amp; U </title><style>p{}</style></head><body><nav class="top x">menu</nav>
      <h1>One</h1><p>a<br>b<script>var s = "</p>";</script><h3>Three</h3><ul><li>i<li>j <p>in</p></ul><table><tr><td>c<th>d</table><pre> x  y </pre><div>outside</div></body></html>"""
    found = extract_html(page, "https://a/", None, {"remove_selectors": ["nav.top"]})
    assert (found["title"], found["html_locale"]) == ("T & U", "en-GB")
    assert texts(found) == [
        ("heading", "One", ["One"]), ("paragraph", "a b", ["One"]), ("heading", "Three", ["One", "Three"]), ("list-item", "i", ["One", "Three"]),
        ("list-item", "j in", ["One", "Three"]), ("table-cell", "c", ["One", "Three"]), ("table-cell", "d", ["One", "Three"]), ("code", "x y", ["One", "Three"]),
    ]


def test_locale_order_and_given_title():
    page = '<html><head><meta name="language" content="nl"><meta property="og:locale" content="de_DE"><title>own</title></head><p>x'
    found = extract_html(page, None, "given")
    assert (found["title"], found["html_locale"]) == ("given", "de_DE")


def test_external_links_are_kept_as_markdown():
    page = '<p>see <a href="https://x.org/a#f">it [now]</a> and <a href="/b">own</a></p><a href="https://y.org/">alone</a>'
    found = extract_html(page, "https://a.b/", None, {"preserve_external_links": True, "internal_hosts": ["a.b"]})
    assert [b["text"] for b in found["blocks"]] == [r"see [it \[now\]](<https://x.org/a>) and own", "[alone](<https://y.org/>)"]


def test_strip_text_and_blank_blocks():
    found = extract_html("<p>Copyright X</p><p>text Copyright X end</p>", None, None, {"strip_text": ["Copyright X"]})
    assert [b["text"] for b in found["blocks"]] == ["text end"]


def test_content_selectors():
    page = "<body><p>menu</p><div class='main'><h1>A</h1><p>x</p></div></body>"
    assert [b["text"] for b in extract_html(page, None, None, {"content_selectors": [".none", "div.main"]})["blocks"]] == ["A", "x"]


def test_equal_elements_are_all_removed():
    icon = "<svg><g><path/></g></svg>"
    assert [b["text"] for b in extract_html(f"<body><p>Text</p>{icon}{icon}</body>")["blocks"]] == ["Text"]
    twins = '<div class="ad"><p>Buy</p></div>' * 2
    assert [b["text"] for b in extract_html(f"<body>{twins}<p>Text</p></body>", None, None, {"remove_selectors": [".ad"]})["blocks"]] == ["Text"]
    plain = '<p class="ad">Buy now</p>' * 2
    assert [b["text"] for b in extract_html(f"<body>{plain}<p>Text</p></body>", None, None, {"remove_selectors": [".ad, p.none"]})["blocks"]] == ["Text"]
    same = '<p><a href="https://x.org/">one</a> and <a href="https://x.org/">one</a></p>'
    assert [b["text"] for b in extract_html(same, "https://a.b/", None, {"preserve_external_links": True})["blocks"]] == ["[one](<https://x.org/>) and [one](<https://x.org/>)"]


def test_deep_pages():
    assert [b["text"] for b in extract_html("<div>" * 5000 + "<p>deep" + "<i>" * 5000 + "er")["blocks"]] == ["deeper"]


def test_headings_by_the_rules_of_commonmark():
    wanted = {"# A": (1, "A"), "   ## A ##": (2, "A"), "# C#": (1, "C#"), "#\tA # #": (1, "A #"), "###### A": (6, "A")}
    assert {line: atx_heading(line) for line in wanted} == wanted
    assert not any(map(atx_heading, ["#A", "    # A", "####### A", "#", "# ", "## ##", "A # B"]))


@pytest.mark.parametrize("selector, want", [("div > p", 1), ("div p", 2), ("#a", 1), ("p.c.d", 1), ("[data-x^=ab]", 1), ("[data-x$=cd], #a", 2), ("em", 0), ("[data-x]", 1)])
def test_selectors(selector, want):
    root = parse('<div id="a"><p class="c d">1</p><section><p data-x="abcd">2</p></section></div>')
    assert len(select(root, selector)) == want


def test_markdown():
    found = markdown_blocks("# A #\n\none\ntwo\n\n### C\r\n- x\n####### no\n")
    assert [(b["type"], b["text"], b["heading_path"]) for b in found] == [("heading", "A", ["A"]), ("paragraph", "one two", ["A"]), ("heading", "C", ["A", "C"]), ("paragraph", "- x ####### no", ["A", "C"])]


def test_json_tree_fields_and_fallback():
    value = {"a": 1, "b": {"c": [True, None]}, "d": ""}
    assert [b["text"] for b in extract_json(json.dumps(value), None, None, {})["blocks"]] == ["a: 1", "b", "c", "0: true", "1: null", "d:"]
    typed = {"t": {"h": " Title "}, "items": [{"type": "content_text", "content": "<p>x</p>", "in": {"type": "content_text", "content": "<p>y</p>"}}, {"type": "other", "content": "<p>z</p>"}]}
    options = {"json_extract": {"mode": "html-fields", "title_path": ["t", "h"], "locale_from_filename": {"pattern": "_([a-z]+)\\.", "mappings": {"ger": "de"}}}}
    found = extract_json(json.dumps(typed), None, "f_ger.json", options)
    assert (found["title"], found["html_locale"], [b["text"] for b in found["blocks"]]) == ("Title", "de", ["x", "y"])
    assert [b["text"] for b in extract_json("{no", None, None, {})["blocks"]] == ["{no"]


def test_unknown_types_hold_no_text():
    assert extract("x", "image/png") is None
    assert extract(None, "text/html")["blocks"] == []


BLOCKS = [{"type": "heading", "text": "A", "heading_path": ["A"]}, {"type": "paragraph", "text": "First sentence here. Second one there.", "heading_path": ["A"]}, {"type": "paragraph", "text": "Third.", "heading_path": ["A", "B"]}]


def test_chunks_take_context_and_the_last_path():
    found = chunks_of(BLOCKS, 1000)
    assert len(found) == 1 and found[0]["content"] == "A\n\nFirst sentence here.\n\nSecond one there.\n\nThird." and found[0]["heading_path"] == ["A", "B"]
    small = chunks_of(BLOCKS, 12)
    assert small[1]["content"].startswith("A\n") and [c["chunk_index"] for c in small] == list(range(len(small)))
    assert chunks_of([]) == []


words = st.text(alphabet="ab é.!?,x ", max_size=120)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.tuples(words, st.lists(st.sampled_from(["H", "Long heading text"]), max_size=2)), max_size=5), st.integers(4, 60))
def test_chunks_keep_the_budget_and_every_sentence(parts, budget):
    blocks = [{"type": "paragraph", "text": t, "heading_path": p} for t, p in parts]
    found = chunks_of(blocks, budget)
    assert all(c["estimated_tokens"] <= budget or budget < 3 for c in found)
    signs = iter("".join("".join(c["content"].split()) for c in found))
    assert all(sign in signs for t, _ in parts for sign in "".join(t.split()))  # in order, between the contexts


def test_pipeline_outcomes(spark):
    rows = [("https://a/1", "t", "text/plain", "one\n\ntwo", "keep"), ("https://a/2", None, "image/png", "x", "keep"), ("https://a/3", None, "text/html", "<p> </p>", "keep"), ("https://a/4", None, None, None, "keep")]
    items = spark.createDataFrame(rows, "canonical_url string, title string, content_type string, body string, source_id string")
    found = documents(items)
    assert {r["canonical_url"][-1]: r["outcome"] for r in found.collect()} == {"1": "document", "2": "skipped", "3": "skipped", "4": "skipped"}
    counts = source_counts(found, ["source_id"]).first()
    assert (counts["processed"], counts["document_count"], counts["skipped_count"], counts["empty_or_short_document_count"]) == (4, 1, 3, 1)
    packed = chunks(found.withColumnRenamed("new_blocks", "blocks").filter("outcome = 'document'"), 5).collect()
    assert [c["content"] for c in packed] == ["one\n\ntwo"] or len(packed) == 2
    assert documents(items.limit(0)).count() == 0
