"""Recall and precision on sets with planted cases, generated from parts that the operators' lists don't name."""

import random

from siltstone.llm import boilerplate, language, quality, residue
from tests.llm.test_text_operators import PAGES, SENTENCES, extracted


def scores(found: set, planted: set) -> tuple[float, float]:
    return len(found & planted) / len(planted), len(found & planted) / max(1, len(found))


NOUNS = ["lantern", "harbour", "ledger", "orchard", "compass", "bridge", "kettle", "archive", "meadow", "loom", "anchor", "barrel", "chapel", "ferry", "granary", "hammer"]
DOINGS = [
    "You can move the {} to the {} when the rain has ended.", "The {} is kept beside the {} because nobody has a key for it.", "Before the {} is opened, all of the people at the {} are told about it.",
    "It was never clear why the {} had been sold with the {}.", "Ask the keeper of the {} if the {} is not where it should be.", "The {} of this town is older than the {} by about a hundred years.", "A new {} and an old {} were brought to us in the spring.",
]


def article(rnd, n=6) -> str:
    return "\n".join(" ".join(rnd.choice(DOINGS).format(*rnd.sample(NOUNS, 2)) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_planted_residue(spark):
    rnd = random.Random(12)
    names = ["Alvorn", "Bestrin", "Cormel", "Dunvar", "Elstow", "Farnim"]
    forms = ["{{{{ {} }}}}", "${{{}}}", "[[{}]]", "%%{}%%", "<%= {} %>", "~~{}~~", "*|{}|*", "<<{}>>", "[TBD: {}]"]
    slots = ["Send the forms to {} before the month is over.", "This part was written for {}, who keeps the town alive."]
    errors = ["The ferry to this page has sunk, call again in {} hours.", "{} can't be shown to guests, ask its owner for a key.", "Nothing lives at this address since the move of {}."]
    rows, planted = [], set()
    for i in range(900):
        title, text = f"{rnd.choice(['Move', 'Keep', 'Sell', 'Open', 'Share'])} the {rnd.choice(NOUNS)} and the {rnd.choice(NOUNS)}", article(rnd)
        if i % 9 == 0:
            where = rnd.choice(slots).format(rnd.choice(forms).format(rnd.choice(["owner_name", "valid_until", "town"])))
            text, _ = text + "\n" + where, planted.add(i)
        elif i % 9 == 1:
            text, _ = "\n".join(rnd.sample(errors, rnd.choice([1, 1, 2]))).format(*[rnd.choice([rnd.choice(names), "12", "7"])] * 2), planted.add(i)
        elif i % 9 == 2:
            text += "\n" + rnd.choice(slots).format(rnd.choice(names))
        rows.append((i, f"s{i % 7}", title, None, text, None))
    recall, precision = scores({r[0] for r in residue.residue(extracted(spark, rows)).collect()}, planted)
    assert recall >= 0.95 and precision >= 0.95, (recall, precision)


def test_planted_furniture(spark):
    rnd = random.Random(13)
    rows, planted, every = [], set(), set()
    menus = {s: rnd.sample(NOUNS, 6) for s in range(3)}
    for i in range(90):
        site, blocks, body = i % 3, [], []

        def add(kind, text, furniture, linked=False):
            if furniture:
                planted.add((i, len(blocks)))
            every.add((i, len(blocks)))
            blocks.append((kind, text, []))
            body.append(f"<a href='x'>{text}</a>" if linked else f"<p>{text}</p>")

        head = f"How the {rnd.choice(NOUNS)} came to the {rnd.choice(NOUNS)} of number {i}"
        for entry in menus[site]:
            add("list-item", entry.title(), True, True)
        add("paragraph", f"Start > {menus[site][0].title()} > {menus[site][1].title()}", True)
        add("heading", head, False)
        for _ in range(rnd.randint(2, 5)):
            add("paragraph", " ".join(rnd.choice(DOINGS).format(*rnd.sample(NOUNS, 2)) for _ in range(rnd.randint(1, 3))), False)
            if rnd.random() < 0.3:
                add("heading", "The {} and the {} of {}".format(*rnd.sample(NOUNS, 3)), False)
                add("list-item", rnd.choice(DOINGS).format(*rnd.sample(NOUNS, 2)), False)
        add("paragraph", f"© 20{10 + site} The friends of {menus[site][2]}", True)
        add("list-item", f"House rules of {menus[site][3]}", True, True)
        rows.append((i, f"s{site}", head, "text/html", "".join(body), blocks, "k", "t"))
    found = {(r[0], r[1]) for r in boilerplate.page_blocks(spark.createDataFrame(rows, PAGES)).filter("boilerplate").collect()}
    recall, precision = scores(found, planted)
    assert recall >= 0.95 and precision >= 0.95, (recall, precision)


MORE = {
    "en": "Nobody had told them which of the roads would be closed in the winter.", "de": "Niemand hatte ihnen gesagt, welche der Straßen im Winter gesperrt wird.", "nl": "Niemand had hun verteld welke van de wegen in de winter dicht zou zijn.",
    "fr": "Personne ne leur avait dit quelle route serait fermée pendant cet hiver.", "es": "Nadie les había dicho cuál de los caminos estaría cerrado en el invierno.", "it": "Nessuno aveva detto loro quale delle strade sarebbe stata chiusa in inverno.", "pt": "Ninguém lhes tinha dito qual das estradas estaria fechada no inverno.",
}


def test_planted_languages(spark):
    rnd = random.Random(14)
    tags = list(SENTENCES)
    line = lambda t: " ".join(rnd.choice([SENTENCES, MORE])[t] for _ in range(rnd.randint(1, 2)))
    rows, want = [], {}
    for i in range(420):
        first, second = rnd.sample(tags, 2)
        mixed = i % 4 == 0
        lines = [line(first) for _ in range(3)] + ([line(second) for _ in range(2)] if mixed else [])
        given = first if i % 3 else rnd.choice([None, second, "xx"])
        rows.append((i, "s", None, given, "\n".join(lines), None))
        want[i] = [first, second] if mixed else [first]
    frame = extracted(spark, rows)
    labelled = language.label_documents(frame, language.fit(frame)).collect()
    parts = {}
    for r in sorted((r for r in labelled if r["segment_no"] > 0), key=lambda r: r["segment_no"]):
        parts.setdefault(r["extract_id"], []).append(r["lang"])
    main = {r["extract_id"]: r["lang"] for r in labelled if r["segment_no"] == 0}
    right = sum(main[i] == w[0] and parts.get(i, [w[0]]) == w for i, w in want.items() if len(w) == 1) + sum(parts.get(i) == w for i, w in want.items() if len(w) == 2)
    assert right >= 0.97 * len(want), right / len(want)


def test_planted_junk(spark):
    rnd = random.Random(15)
    rows, planted = [], set()
    for i in range(600):
        tag = rnd.choice(list(SENTENCES))
        prose = [rnd.choice([SENTENCES, MORE])[tag] for _ in range(rnd.randint(4, 8))]
        kind = i % 6
        junk = {
            0: [", ".join(rnd.sample(NOUNS, 8)) for _ in range(6)],
            1: ["\t".join([rnd.choice(NOUNS), str(rnd.randint(1, 999)), f"{rnd.random():.2f}"]) for _ in range(12)],
            2: [f"2024-01-{rnd.randint(10, 28)} 10:{rnd.randint(10, 59)}:01 WARN [{rnd.choice(NOUNS)}] code={rnd.randint(100, 999)} took={rnd.randint(1, 99)}ms" for _ in range(9)],
        }.get(kind)
        if junk:
            rows.append((i, "\n".join(prose[:1] + junk), tag))
            planted.add(i)
        else:
            some = [", ".join(rnd.sample(NOUNS, 5))] if kind == 3 else []
            rows.append((i, ("\n" if kind == 4 else " ").join(prose) + "\n" + "\n".join(some), tag))
    found = quality.not_prose(quality.document_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    recall, precision = scores({r["key"] for r in found.collect()}, planted)
    assert recall >= 0.97 and precision >= 0.97, (recall, precision)
