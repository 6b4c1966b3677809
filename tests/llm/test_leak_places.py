import pickle
import random
import tracemalloc

import numpy as np

from siltstone.llm import leakage

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def test_words_of_short_items_have_a_place(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choices(words, k=60))) for i in range(20)] + [(99, "only these five short words")]
    docs = [
        (1, "before it only these five short words and after"),
        (2, "noise " + " ".join(items[3][1].split()[10:30]) + " noise"),
        (3, "only these five words"),
        (4, "Only these five short words!"),
    ]
    found = leakage.leaked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert {tuple(r) for r in found.collect()} == {(1, 99), (2, 3), (4, 99)}


def test_many_passages_are_searched_in_bounded_blocks():
    rnd = np.random.default_rng(8)
    words = [f"w{i}" for i in range(5000)]
    texts = [(i, " ".join(words[j] for j in rnd.zipf(1.3, 212) % 5000)) for i in range(500)]
    held = leakage.Items(texts, 13)
    latent = rnd.standard_normal((len(held.terms), 80))
    probe = np.concatenate([held.sequences[i][:13][None] for i in range(400)])
    tracemalloc.start()
    seen, found = 0, np.zeros(len(probe), dtype=int)
    for block in leakage.item_blocks(held, latent, 13):
        assert sum(len(b.owner) for b in block) <= leakage.BLOCK_PASSAGES and len(pickle.dumps(block)) < 32 << 20
        for places in block:
            seen += len(places.owner)
            for a, b, _ in places.near(probe, latent, 0.95):
                same = (probe[a] == places.passages[b]).all(axis=1)
                np.add.at(found, a[same], 1)
    assert seen == 100_000 and (found > 0).all()
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_recall_of_planted_paraphrases(spark):
    """Passages of 40 words with one word in eight replaced, dropped or doubled, and answers kept."""
    rnd = random.Random(6)
    words = [f"word{i}" for i in range(3000)]
    items, docs = [], []
    for i in range(60):
        text = rnd.choices(words, k=50) + [f"{1000 + i}"]
        rnd.shuffle(text)
        items.append((i, " ".join(text)))
        start, told = rnd.randrange(10), []
        for w in text[start : start + 40]:
            told += rnd.choice([[rnd.choice(words)], [], [w, w]]) if rnd.random() < 0.125 and not w.isdigit() else [w]
        docs.append((i, " ".join(rnd.choices(words, k=rnd.randrange(30)) + told + rnd.choices(words, k=20))))
        docs.append((1000 + i, " ".join(rnd.choices(words, k=90))))
    found = {(r[0], r[1]) for r in leakage.paraphrased(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    planted = {(i, i) for i in range(60)}
    assert len(found & planted) >= 0.9 * len(planted) and found <= planted


def test_answers_tell_paraphrases_from_passages_of_one_pattern(spark):
    frame = "the surveyor of {} hid behind the counter at {} a list of {} names because the bridge to {} had been closed since noon by the mayor"
    items = spark.createDataFrame([(1, frame.format("askeldburg", "rynzilmere", 1789, "dexton")), (2, "quite another text " * 9)], ITEMS)
    docs = [(1, frame.format("askeldburg", "rynzilmere", 1789, "dexton").replace("hid", "kept")), *[(10 + i, frame.format("a", "b", "c", "d")) for i in range(30)]]
    found = {(r["doc_id"], r["item_id"]) for r in leakage.paraphrased(spark.createDataFrame(docs, DOCS), items).collect()}
    assert found == {(1, 1)}
