from siltstone.llm import residue
from tests.llm.test_text_operators import PROSE, extracted

TITLES = ["Move the log", "Share a view", "Known limits", "Questions", "Set up a rule", "Repair the form"]
ERRORS = ["The lantern of {} is out, knock again in {} minutes.", "No heron lives under this name any more, number {1}."]


def test_lines_that_only_stand_on_pages_of_their_own(spark):
    """Error lines no phrase list knows, alone or together, under unlike titles; lines of articles come back as well."""
    rows = [(i, f"s{i % 2}", t, None, ERRORS[0].format(f"Alpha{i}", i), None) for i, t in enumerate(TITLES)]
    rows += [(10 + i, "s0", t, None, "Oops\n" + ERRORS[1].format(0, i), None) for i, t in enumerate(TITLES)]
    rows += [(20, "s3", "A rare title", None, "\n".join(e.format("Beta", 7) for e in ERRORS), None)]
    step = "Open the form of {} and press the knob {} times."
    rows += [(30 + i, "s1", t, None, step.format(f"Beta{i}", i) + f"\nThe text of {chr(97 + i) * 4} is about {chr(98 + i) * 5} alone.\n" + PROSE, None) for i, t in enumerate(TITLES)]
    rows += [(40, "s1", "One step", None, step.format("Gamma", 3), None), (41, "s1", "Other words", None, PROSE + "\n" + ERRORS[0].format("Delta", 4), None)]
    got = {r[0] for r in residue.residue(extracted(spark, rows), prior=False).collect()}
    assert got == {*range(6), *range(10, 16), 20}


def test_slots_hold_whatever_signs(spark):
    """Forms of placeholders that no pattern knows stand in slots that known ones induced, or name a known variable."""
    lines = ["Write to {{owner_name}} before you change the rule.", "Write to ~owner name~ before you change the rule.", "Write to *|BODY|* before you change the rule.", "Write to <<x: y>> before you change the rule.", "Write to OWNER_NAME before you change the rule.", "Write to Anna before you change the rule.", "Look for ~owner name~ in the list of the week."]
    rows = [(i, "s", f"T{i}", None, PROSE + "\n" + line, None) for i, line in enumerate(lines)]
    rows += [(i, "s", t, None, PROSE + f"\nIt is about {chr(97 + i) * 4} alone.", None) for i, t in ((10, "~owner_name~ | Alpha"), (11, "[Beta] Alpha"), (12, None))]
    assert {r[0] for r in residue.residue(extracted(spark, rows)).collect()} == {0, 1, 2, 3, 4, 10}
