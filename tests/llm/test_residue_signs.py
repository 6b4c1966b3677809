import pytest

from siltstone.llm import residue
from tests.llm.test_text_operators import PROSE, extracted

CASES = [
    ("Alpha", PROSE + "\nWrite to {2} before you change the sync agent.", True), ("Fragen zu Alpha - {2}", PROSE, True), ("{2} | Alpha", PROSE, True), ("%1$s - Alpha", PROSE, True),
    ("Alpha", PROSE + '\nIn the mail template, "{0}" stands for the name of the reader.', False), ("Alpha", PROSE + "\nAuthors type {3} where the value should appear.", False), ("Alpha", PROSE + "\nDans le modèle, {3} représente le nom du lecteur.", False),
    ("Alpha", PROSE + "\nThe code follows \\d{3}-[A-Z]{2} on all pages.", False),
]


@pytest.mark.parametrize("title, text, case", CASES)
def test_numbered_placeholders(title, text, case):
    assert residue.is_residue(title, text) is case


def test_signs_in_slots_of_known_frames(spark):
    rows = [(1, "s", "A", None, "Write to {2} before you change the rule.", None), (2, "s", "B", None, "Write to [mail] before you change the rule.", None), (3, "s", "C", None, PROSE + "\nSee [mail] for the rule.", None)]
    assert {r[0] for r in residue.residue(extracted(spark, rows)).collect()} == {1, 2}


BARE = [
    "{{a}}", "{{ a.b }}", "{% if a %}", "{%- a -%}", "${a}", "#{a}", "@{a}", "<%= a %>", "<% a %>", "%%A%%", "[[a]]", "@@A@@", "__A__", "<your name>", "<Ihr name>", "<votre nom>", "<su nombre>", "<uw naam>", "<il vostro nome>", "<o seu nome>",
    "[insert name]", "[Add name]", "[inserire nome]", "[naam hier invullen]", "[name hier einfügen]", "[naam hier]", "XXX name XXX", "{0}", "{12}", "%1$s", "%1s",
]


@pytest.mark.parametrize("sign", BARE)
def test_signs_hold_wherever_placeholders_do(sign):
    assert residue.PLACEHOLDER.fullmatch(sign) or residue.NUMBERED.fullmatch(sign)
    assert residue.SIGNS.search(sign)


@pytest.mark.parametrize("text", ["%1$s\n%2$s", "%1s %2s"])
def test_pages_of_bare_numbered_placeholders(text):
    assert residue.is_residue("Alpha", text)
    assert residue.is_residue("Alpha", PROSE + "\nWrite to %1$s before you change the rule.")


def test_repeated_pages_of_any_length_and_of_one_source(spark):
    titles = ["Move the log", "Share a view", "Known limits", "Questions"]
    gone = "This view of Alpha{} is gone for {} days now. " + " ".join(f"It went away with step {k} of the plan." for k in range(40))
    rows = [(i, "hot", t, None, gone.format(i, i), None) for i, t in enumerate(titles)] + [(10 + i, f"s{i}", t, None, gone.format(i, i).replace("gone", "lost"), None) for i, t in enumerate(titles)]
    rows += [(20 + i, "hot", t, None, f"The way to it is closed, ask us at {i}", None) for i, t in enumerate(titles)]
    rows += [(30 + i, "hot", f"Set up {p}", None, f"The team sets up the rule of {p} within a day, and it can be restored.", None) for i, p in enumerate(["Alpha", "Beta", "Gamma"])]
    rows += [(40 + i, "hot", "Same", None, "The same article is kept as it is with each of the runs of the week.", None) for i in range(4)]
    assert {r[0] for r in residue.residue(extracted(spark, rows)).collect()} == {*range(4), *range(10, 14), *range(20, 24)}


def test_more_frames_than_the_driver_would_hold(spark):
    word = lambda k: "".join(chr(97 + k // 26**j % 26) for j in range(4))
    rows = [(i, "s", "A", None, "\n".join(f"The {word(i * 100 + k)} {{{{v{word(i * 100 + k)}}}}} is {word(k)} now" for k in range(100)), None) for i in range(205)]
    rows += [(1000 + i, "s", "B", None, f"The {word(i)} undefined is {word(i % 100)} now", None) for i in (0, 9_999, 20_499)]
    assert {r[0] for r in residue.residue(extracted(spark, rows)).collect()} == {*range(205)} | {1000, 10_999, 21_499}
