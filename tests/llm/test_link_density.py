import time

from siltstone.llm import boilerplate as B


def test_links_of_any_length_and_blocks_of_several_links():
    long = "word " * 1000
    body = f'<a href="{"x" * 5000}">Home</a> | <A class=y>Pro<b>ducts</b></A >, <a>open <a href=z>Next</a><p>{long}</p><a href=q>{long}</a><abbr>no</abbr>'
    links = B.links_of(body, "text/html")
    assert {"home", "products", "open", "next", long.strip()} == links
    assert B.link_density("home | products | next", links) == 1.0
    assert B.link_density("home", links) == 1.0 and B.link_density("home of all", links) == 0.0
    assert 0 < B.link_density("home | what the others said", links) < B.DENSE_LINKS
    assert B.link_density("", links) == B.link_density("home", frozenset()) == 0.0


def test_a_line_of_links_is_no_article_text():
    types, texts = ["paragraph", "heading", "paragraph"], ["Log book | Rule | Form", "The rule", "The rule is kept in the log and it can be changed by all of the team."]
    links = frozenset({"log book", "rule", "form"})
    assert B.labels_of(types, texts, "The rule", links, frozenset()) == [True, False, False]


def test_many_open_anchors_take_no_time():
    began = time.monotonic()
    B.links_of("<a href=x" * 100_000, "text/html")
    B.links_of("<a>" * 100_000, "text/html")
    assert time.monotonic() - began < 5
