import random
import re
import unicodedata
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import boilerplate, language, quality, repeated_lines, residue, splitting

BLOCKS = "array<struct<type:string,text:string,heading_path:array<string>>>"
EXTRACTED = f"extract_id long, source_id string, title string, locale string, html_locale string, normalized_content string, blocks {BLOCKS}, key string, text string, line string"


def extracted(spark, rows):
    """rows of (extract_id, source_id, title, locale, content, blocks), with columns whose names clash with inner ones."""
    full = [(i, s, t, loc, None, c, b, "k", "t", "l") for i, s, t, loc, c, b in rows]
    return spark.createDataFrame(full, EXTRACTED)


# --- splitting

texts = st.text(alphabet=st.sampled_from(list("abc .!?,\n\r é́‍😀👍🏽漢。")), max_size=400)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(texts, st.integers(20, 80), st.integers(0, 15))
def test_pieces_cover_the_text_with_the_overlap(text, limit, overlap):
    found = splitting.pieces(text, limit, overlap)
    assert all(0 <= a and b - a <= limit for a, b in found)
    if len(text) <= limit:
        assert found == [(0, len(text))]
        return
    assert found[0][0] == 0 and found[-1][1] == len(text)
    for (a, b), (c, d) in zip(found, found[1:]):
        assert c == max(0, b - overlap) and d > b >= a
    assert "".join(text[max(a, p):b] for (a, b), p in zip(found, [0, *[x[1] for x in found]])) == text


def test_cuts_prefer_strong_boundaries():
    para = "One two three. Four five six. " * 3
    text = para + "\n\n" + para + "\n" + para
    cut = splitting.best_cut(splitting.strengths(text), 0, len(text))
    assert text[:cut].endswith("\n\n")
    plain = "word " * 100
    assert all(plain[a - 1] == " " for a, _ in splitting.cuts(plain, 100, 10)[1:])
    assert len(splitting.cuts("x" * 5000, 2000, 200)) == 4
    family = "👩‍👧" * 40
    assert all(family[a] == "👩" for a, _ in splitting.cuts(family, 60, 0)[1:])


def test_items_over_the_limit(spark):
    long, short = "Sentence one. " * 200, "x" * 2000
    block = lambda t: ("paragraph", t, [])
    rows = extracted(spark, [(1, "s", None, None, long, [block(short), block(long), block(None)]), (1, "s", None, None, long, [block(short), block(long), block(None)]), (2, "s", None, None, None, None), (3, "s", None, None, "", []), (4, "s", None, None, "y" * 2001, None)])
    got = splitting.split_items(rows).distinct().collect()
    assert {(r["extract_id"], r["item_no"]) for r in got} == {(1, -1), (1, 1), (4, -1)}
    assert all(len(r["content"]) == r["end"] - r["start"] <= 2000 for r in got)
    assert splitting.split_items(rows.limit(0)).count() == 0


# --- repeated lines

def brute_lines(rows):
    records, seen, places = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, s, _, _, content, _ in rows:
        records[s or ""].add(i)
        for no, line in enumerate(x for x in re.split(r"[\n\r]+", content or "") if x.strip()):
            key = "".join(c for c in re.sub(r"\d+", "0", unicodedata.normalize("NFKC", line).lower()) if c.isalnum())
            if sum(c.isalpha() for c in key) >= 3:
                seen[s or "", key].add(i)
                places[s or "", key].add((i, no))
    return {p for k, v in seen.items() if len(v) >= 5 and len(v) * 20 >= len(records[k[0]]) for p in places[k]}


def test_repeated_lines_against_brute_force(spark):
    rnd = random.Random(4)
    frequent = ["© 2020 Alpha Corp. All rights reserved", "Share this | Copy  link", "Ünïcode ﬁne line", "12 34", "ab 1"]
    rows = []
    for i in range(160):
        source = "hot-alpha" if i % 3 else rnd.choice(["b", None])
        lines = ["own text " + "".join(rnd.choices("abcdefghij", k=9)) + " of this record" for _ in range(3)]
        for f in rnd.sample(frequent, 2):
            f = re.sub(r"\d+", lambda m: str(rnd.randint(1, 99)), f)
            lines.insert(rnd.randint(0, 3), rnd.choice([f, f.upper(), f + " >>", "  * " + f, f.replace(" | ", "|").replace("  l", "l"), f.replace(" ", "")]))
        rows.append((i, source, None, None, rnd.choice(["\n", "\r\n", "\n\n"]).join(lines), None))
    rows += [rows[0], (900, "hot-alpha", None, None, None, None), (901, "b", None, None, "", None), (902, "b", None, None, " \n ", None)]
    found = repeated_lines.Repeats(extracted(spark, rows))
    got = {tuple(r) for r in found.places().collect()}
    assert got == brute_lines(rows) and got
    assert found.clusters().filter("lines > 0").count() > 0
    cleaned = {r["extract_id"]: r["content"] for r in repeated_lines.without_places(extracted(spark, rows), found.places()).collect()}
    assert all("own text" in c for i, c in cleaned.items() if i < 160) and 900 not in cleaned
    assert not any("rights reserved" in c.lower() for i, c in cleaned.items() if i < 160 and i % 3)


def test_no_lines_at_all(spark):
    assert repeated_lines.Repeats(extracted(spark, [])).places().count() == 0


def test_near_equal_lines_share_bands():
    words = [repeated_lines.shingle_words(t, frozenset({"alpha"})) for t in ("alpha shares on 12/3/2024 this article with all of your colleagues and friends today", "alpha shares on 1.4-2023 this article with all of your colleagues and friends today")]
    assert words[0] == words[1] and words[0][0] == "n" and words[0].count("0") == 1
    assert repeated_lines.line_identity("Last — 12/3 ①!") == repeated_lines.line_identity("LAST 99.1 1")


# --- language

SENTENCES = {
    "en": "The house is near the river and it has been there for many years with a garden.",
    "de": "Das Haus steht an dem Fluss und es ist nicht weit von der Stadt für die Leute.",
    "nl": "Het huis staat bij de rivier en het is niet ver van de stad voor de mensen.",
    "fr": "La maison est près de la rivière et elle n'est pas loin de la ville pour les gens.",
    "es": "La casa está cerca del río y no se ve lejos de los pueblos con más gente.",
    "it": "La casa è vicino al fiume e non è lontano dalla città per gli amici che sono con noi.",
    "pt": "A casa fica perto do rio e não é longe da cidade para os amigos que estão com as famílias.",
}


def labelled(spark, rows):
    frame = extracted(spark, [(i, "s", None, loc, c, None) for i, (loc, c) in enumerate(rows)])
    return language.label_documents(frame, language.fit(frame))


def test_languages_and_mixed_records(spark):
    rows = [(k, v) for k, v in SENTENCES.items()] * 3
    mixed = "\n".join([SENTENCES["de"], "42 %", 'for x in a_b: push(x, 3); {"mode": "y"}', SENTENCES["de"], SENTENCES["fr"] * 3, "", SENTENCES["de"]])
    special = [("en", mixed), ("de-AT", SENTENCES["de"]), ("en", SENTENCES["nl"]), (None, "Nams tesis ponus quast sintnis dicinis vole mitutum dosa arca."), ("unknown", "x = {y: 1}; 12"), ("und", "12 34"), ("fr", None), ("fr", "  \n"), ("FR_ca", SENTENCES["fr"])]
    at = len(rows)
    found = labelled(spark, rows + special)
    whole = {r["extract_id"]: r["lang"] for r in found.filter("segment_no = 0").collect()}
    assert [whole[i] for i in range(7)] == list(SENTENCES)
    assert {i - at: whole.get(i) for i in range(at, at + 9)} == {0: "fr" if sum(map(str.isalpha, SENTENCES["fr"])) > sum(map(str.isalpha, SENTENCES["de"])) else "de", 1: "de", 2: "nl", 3: "und", 4: "und", 5: "und", 6: None, 7: None, 8: "fr"}
    parts = [(r["segment_no"], r["lang"], r["first_line"], r["last_line"]) for r in found.filter(f"extract_id = {at} and segment_no > 0").orderBy("segment_no").collect()]
    assert parts == [(1, "de", 0, 3), (2, "fr", 4, 4), (3, "de", 5, 5)]
    wrong = {r["extract_id"] - at for r in language.wrong_or_mixed(found).collect()}
    assert wrong == {0, 2, 4}
    assert all(0 <= r["confidence"] <= 1 for r in found.collect())


def test_held_out_accuracy(spark):
    rnd = random.Random(6)
    words = {k: v.rstrip(".").split() for k, v in SENTENCES.items()}
    train = [(rnd.choice(list(words)) if rnd.random() < 0.1 else k, " ".join(rnd.choices(words[k], k=20))) for k in words for _ in range(30)]
    frame = extracted(spark, [(i, "s", None, loc, c, None) for i, (loc, c) in enumerate(train)])
    model = language.fit(frame)
    held = [(k, " ".join(rnd.choices(words[k], k=12))) for k in words for _ in range(20)]
    labels = language.Labeller(model).label([t for _, t in held])
    right = sum(language.LANGUAGES[x[0][0]] == k for x, (k, _) in zip(labels, held))
    assert right >= 0.95 * len(held)


def test_language_of_nothing_and_of_very_long_texts(spark):
    assert labelled(spark, []).count() == 0
    long = labelled(spark, [("en", (SENTENCES["en"] + " ") * 20_000)] + [(k, v) for k, v in SENTENCES.items()])
    assert long.filter("extract_id = 0").first()["lang"] == "en"


# --- quality

PROSE = "The team keeps a copy of every rule and it can be restored within a day. If the status stays on hold, ask an owner for help with the queue."


@pytest.mark.parametrize(
    "text, prose",
    [
        (PROSE, True), ("Q: Why is it so?\nA: " + PROSE, True), ("> " + PROSE.replace(". ", ".\n> "), True), (PROSE + "\n\n- a\n- b\nx | y | z", True),
        ("\n".join(PROSE[i : i + 50] for i in range(0, len(PROSE), 50)), True), ("1) Open the page of the rule.\n2) Wait for it to load and press the button.", True),
        ("access log, login page, ticket view, user directory, sync agent, audit trail", False), ("| a | b |\n|---|---|\n" + "| Alpha | 3.4 |\n" * 9, False), ("id;name;qty\n" + "12;Alpha;4\n" * 9, False),
        ("2024-01-01T00:00:00 INFO [x-1] a=1\n" * 6, False), ("function a1(b){return b*2};" * 9, False), ("aGVsbG8gd29ybGQ" * 20, False), ("https://a.example/b/1?c=2\n" * 5, False),
        ("search index search index audit trail search index login page", False), ("!!! ??? *** 🔥🔥 ✅", False), ("Tze firÃ¶tÃ©ru¬ztaÃ¤es aÃ¼oÃ³t¬45 minutzs of the qlÃ©tzrÃ¼rÃ¤wÃ³ only", False), ("1.1 login page ........ 3\n1.2 audit trail ..... 7", False),
    ],
)
def test_prose_share(text, prose):
    assert (quality.prose_share(text) > 0.5) is prose


def test_statistics_and_tails(spark):
    docs = [(i, PROSE + f" Number {i}.", "en", "key") for i in range(40)] + [(100, "login page, audit trail, sync agent, ticket view", "en", "key"), (101, None, "en", "key"), (102, "", None, "key"), (103, " \n ", "xx", "key"), (104, "12;a;3\n" * 9, "DE_at", "key"), (104, "12;a;3\n" * 9, "DE_at", "key")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, key string")
    stats = quality.document_statistics(frame)
    assert sorted(r["key"] for r in quality.not_prose(quality.document_quality(frame)).select("key").distinct().collect()) == [100, 104]
    row = stats.filter("key = 100").first()
    assert (row["word_count"], row["ended_share"], row["sentence_share"]) == (8.0, 0.0, 0.0)
    assert stats.filter("key = 104").first()["lang"] == "de"
    table = {r["lang"]: r for r in quality.quantile_table(quality.distributions(stats)).collect()}
    assert table["*"]["n"] == 43 and table["en"]["n"] == 41 and table["*"]["sentence_share_mid"] > 0.9
    assert quality.not_prose(quality.document_quality(frame.limit(0))).count() == 0


# --- residue

CASES = [
    ("Alpha", "Welcome to {{product}}, the place for all of you.", True), ("Alpha", "Write to @@MAIL@@ before you change the rule of the page.", True), ("A - [[TITLE]]", PROSE, True), ("Repair the report template (A) - {{x}}", PROSE, True), ('How "{{name}}" is filled', PROSE, False), ("A", PROSE + "\nTODO: write this section.", True),
    ("A", "Version <your version> of it brings a new view of the page.", True), ("A", "Schrijf naar [naam hier invullen] voordat je de regel wijzigt.", True), ("A", "Version XXX name XXX of the page is new.", True),
    ("Error 404", "Page not found\n404", True), ("A", "Oops\nThis portal needs scripts to run. Turn them on and reload the page.", True), ("A", "Votre session a expiré, veuillez vous reconnecter.", True), ("A", "<%= title %>\n__BODY__ {0}", True),
    ("A", "Nams tesis ponus quast sintnis dicinis vole mitutum dosa arca volem erattum namtum.", True), ("A", "This is a placeholder article. The real text will follow once the team has written it.", True),
    ("A", PROSE, False), ("A", PROSE + '\nIn the mail template, "{{name}}" stands for the reader.', False), ("A", PROSE + "\nAuthors type ${name} where the value should appear.", False), ("A", PROSE + "\nIn der Vorlage steht %%NAME%% für den Namen.", False),
    ("A", PROSE + "\nError 404 means that the address is not known. A page not found can be redirected.", False), ("A", "", False), ("A", "Dans le modèle, #{name} représente le nom du lecteur.\n" + PROSE, False), ("A", PROSE + "\n54 %\n{\"a_b\": [1, 2]}", False),
]


@pytest.mark.parametrize("title, text, case", CASES)
def test_residue_of_one_record(title, text, case):
    assert residue.is_residue(title, text) is case


def test_residue_with_frames_and_repeated_pages(spark):
    rows = [(i, "s", t, None, x, None) for i, (t, x, _) in enumerate(CASES)]
    rows += [(100, "s", "B", None, "Version product_name of it brings a new view of the page.", None), (101, "s", "B", None, "The word product_name is a name of the page for you.", None)]
    rows += [(102, "s", "C", None, "Version <your product name> of it brings a new view of the page.", None)]
    rows += [(200 + i, f"s{i}", f"T{i}", None, f"This view of Alpha{i} is gone for {i} days now", None) for i in range(3)] + [(300 + i, f"s{i}", "same", None, "A short but real text for the page", None) for i in range(3)]
    rows += [rows[0], (400, "s", None, None, None, None), (401, "s", "{{x}}", None, " ", None), (402, "s", "{{x}}", None, None, None)]
    got = {r[0] for r in residue.residue(extracted(spark, rows)).collect()}
    assert got == {i for i, (_, _, case) in enumerate(CASES) if case} | {100, 102, 200, 201, 202}
    assert residue.residue(extracted(spark, [])).count() == 0


# --- boilerplate

PAGE = [
    ("paragraph", "Skip to main content", 1), ("list-item", "Booking form", 1), ("list-item", "Search index", 1), ("paragraph", "Home > Booking form > Alpha", 1), ("heading", "On this page", 1), ("list-item", "Set up the rule", 1),
    ("heading", "What you should know", 0), ("paragraph", "The cookie of the page holds the number of the session only and it can be cleared.", 0), ("heading", "Set up the rule", 0), ("list-item", "Open the log in Alpha", 0), ("paragraph", "Share this page: Mail, Chat", 1),
    ("list-item", "Press Save", 0), ("table-cell", "1.25", 0), ("code", "GET /v1/x", 0), ("paragraph", "Related articles: Move the log", 1), ("paragraph", "To change the navigation menu, open the form and drag the entries into the order that you want.", 0),
    ("heading", "Related articles", 1), ("list-item", "Move the log to Alpha", 1), ("list-item", "Share the view with all of the new colleagues of the whole team", 1), ("paragraph", "Subscribe to updates by mail.", 1), ("list-item", "Imprint", 1), ("paragraph", "© 2022 Alpha. Terms of use.", 1),
]
PAGES = f"page_id long, source_id string, title string, content_type string, body string, blocks {BLOCKS}, key string, texts string"


def test_blocks_of_a_page(spark):
    blocks = [(k, t, []) for k, t, _ in PAGE]
    rows = [(1, "s", "What you should know - Alpha", "text/html", "<a href='x'>Booking form</a>", blocks, "k", "t"), (1, "s", "What you should know - Alpha", "text/html", "<a href='x'>Booking form</a>", blocks, "k", "t"), (2, None, None, None, None, None, "k", "t"), (3, "s", None, "text/plain", None, [], "k", "t"), (4, "s", None, None, None, [(None, None, None)], "k", "t")]
    got = {(r[0], r[1]): r[2] for r in boilerplate.page_blocks(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[1, i] for i in range(len(PAGE))] == [bool(b) for *_, b in PAGE]
    assert {k[0] for k in got} == {1, 4}
    main = boilerplate.main_text(spark.createDataFrame(rows[:2], PAGES)).first()["content"]
    assert main.splitlines() == [t for _, t, b in PAGE if not b]
    assert boilerplate.page_blocks(spark.createDataFrame([], PAGES)).count() == 0


def test_blocks_that_a_whole_site_carries(spark):
    rows = [(i, "s", f"Head {i}", "text/plain", None, [("paragraph", f"Head {i}", []), ("paragraph", f"The text number {i} of the page is about the rules that are kept for all.", []), ("paragraph", "Our five offices", [])], "k", "t") for i in range(6)]
    got = {(r[0], r[1]): r[2] for r in boilerplate.page_blocks(spark.createDataFrame(rows, PAGES)).collect()}
    assert all((got[i, 0], got[i, 1], got[i, 2]) == (False, False, True) for i in range(6))


# --- inputs that make careless patterns slow

@pytest.mark.parametrize("text", ["a" * 200_000 + " -x 1", "{{" + " " * 100_000 + "x", "{{a}}" * 20_000, "[[ " * 50_000, "<a href=x>" * 20_000, "> " * 50_000, "_" * 100_000, ". " * 100_000, "a_" * 50_000, "\n" * 100_000 + "x", "<% " + "a " * 50_000, "your " * 30_000])
def test_long_odd_texts_take_no_time(text):
    import time

    began = time.monotonic()
    residue.is_residue("t", text, frozenset({("a", "b")}), frozenset({"a"}))
    quality.statistics(text)
    splitting.pieces(text)
    language.Labeller({"the": (0.0,) * 7}).label([text])
    boilerplate.links_of(text, "text/html")
    boilerplate.labels_of(["paragraph"], [text], "t", frozenset(), frozenset())
    [repeated_lines.line_identity(x) for x in language.lines_of(text)]
    assert time.monotonic() - began < 8
