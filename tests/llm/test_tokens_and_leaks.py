import random
import unicodedata

import pytest

from siltstone.llm import leakage, tokens

tokenizers = pytest.importorskip("tokenizers")
JSON = tokens.DEFAULT_VOCABULARY.replace(".tiktoken", ".json")


@pytest.fixture(scope="module")
def reference():
    made = tokenizers.Tokenizer.from_file(JSON)
    made.encode_special_tokens = True
    return made


def ours(texts):
    flat, per_text, _, _ = tokens.encode(texts)
    out, at = [], 0
    for n in per_text:
        out.append(flat[at : at + n])
        at += n
    return out


def same(texts, reference):
    assert ours(texts) == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]


def test_corner_cases(reference):
    same(["don't we'll I'd've", "''s 's 't", " 's", "x\n\n y", "  ", "a  b\t\tc \n", "", "'", "'r", "'rex", "'llx", "n't's't", "\n's", "1'd2", "<|endoftext|>", "é 　 x", "\x00\x1c\x85", "👩‍👧🏽", "漢字かな", "a" * 5000, " " * 300 + "x"], reference)


def test_random_texts(reference):
    rnd = random.Random(1)
    signs = list("'''strvelmdx  \n\t1.é漢😀")
    same(["".join(rnd.choices(signs, k=rnd.randint(0, 16))) for _ in range(4000)], reference)


def test_every_codepoint_class(reference):
    rnd = random.Random(2)
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same(["a" + chr(c) + "1 " + chr(c) for c in rnd.sample(codes, 20_000)], reference)


def test_round_trip_and_offsets():
    texts = ["Héllo  wörld's 😀", "", "x\n\ny", "plain"]
    for text, ids in zip(texts, ours(texts)):
        assert tokens.decode(ids) == text
    _, _, begins, sizes = tokens.encode(texts[:1])
    data = texts[0].encode()
    pieces = [data[a:b] for a, b in zip(begins, [*begins[1:], len(data)])]
    assert b"".join(pieces) == data and sizes.sum() == len(ours(texts[:1])[0])


def test_long_texts_go_in_parts(reference, monkeypatch):
    monkeypatch.setattr(tokens, "PART", 50)
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(list("ab'st  \n\t1.é"), k=700)) for _ in range(30)] + ["x" * 300, "", "a b"]
    same(texts, reference)
    assert max(map(len, tokens.safe_parts("word " * 100))) < 60
    _, per_text, begins, sizes = tokens.encode(texts)
    assert sizes.sum() == per_text.sum() and begins[0] == 0


def test_long_pieces_merge_like_short_ones():
    m = tokens.merger(tokens.DEFAULT_VOCABULARY)
    word = ("internationalization" * 40).encode()
    assert b"".join(tokens.backwards(tokens.DEFAULT_VOCABULARY)[i] for i in m.merge(word)) == word


def test_encoded_tables(spark, reference):
    rows = [(1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (4, " \n", "x"), (1, "Hello world", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in tokens.encoded(frame).collect()}
    assert got == {1: reference.encode("Hello world").ids, 2: [], 3: [], 4: reference.encode(" \n").ids}
    offsets = {r["doc_id"]: (r["starts"], r["sizes"]) for r in tokens.piece_offsets(frame).collect()}
    assert offsets[1] == ([0, 5], [1, 1]) and offsets[2] == ([], [])
    assert tokens.encoded(frame.limit(0)).count() == 0


# --- leaks

DOCS, ITEMS = "doc_id long, text string, item_id string, key string", "item_id long, text string, doc_id string"


def brute(docs, items, run=13):
    found = set()
    for i, text in items:
        w = leakage.words_of(text or "")
        if not w:
            continue
        n = min(run, len(w))
        grams = {tuple(w[a : a + n]) for a in range(len(w) - n + 1)}
        for d, content in docs:
            x = leakage.words_of(content or "")
            if any(tuple(x[a : a + n]) in grams for a in range(len(x) - n + 1)):
                found.add((d, i))
    return found


def test_leaks_against_brute_force(spark, monkeypatch):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([3, 9, 13, 20, 60])))) for i in range(40)] + [(100, None), (101, ""), (102, "!!"), (3, None)]
    items += [(200, items[5][1]), items[7]]
    docs = []
    for d in range(120):
        base = rnd.choices(words + [f"other{i}" for i in range(200)], k=80)
        if d % 3 == 0:
            src = leakage.words_of(items[rnd.randrange(40)][1])
            a, n = rnd.randrange(max(1, len(src) - 14)), rnd.choice([8, 12, 13, 14, 40])
            base[30:30] = src[a : a + n]
        docs.append((d, rnd.choice([" ", ", ", "\n"]).join(rnd.choice([w, w.upper()]) for w in base)))
    docs += [(500, None), (501, ""), (502, "ＷＩＤＥ " + unicodedata.normalize("NFKC", items[1][1])), (0, docs[0][1])]
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOCS)
    held = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    want = brute(docs, items)
    assert {tuple(r) for r in leakage.leaked(frame, held).collect()} == want and want
    monkeypatch.setattr(leakage, "GROUP_PASSAGES", 300)
    monkeypatch.setattr(leakage, "BLOCK_PASSAGES", 40)
    monkeypatch.setattr(leakage, "LEAF_PASSAGES", 8)
    assert {tuple(r) for r in leakage.leaked(frame, held).collect()} == want
    assert leakage.leaked(frame, held.limit(0)).count() == 0
    assert leakage.leaked(frame.limit(0), held).count() == 0


def test_paraphrases(spark):
    words = [f"word{i}" for i in range(200)]
    item = " ".join(words[:40]) + " 1789 in 4 towns"
    changed = words[:40]
    changed[5], changed[17], changed[30] = "changed", "other", "new"
    docs = [(1, " ".join(["noise"] * 10 + changed + ["1789", "in", "4", "towns"])), (2, " ".join(words[100:160])), (3, " ".join(reversed(words[:40])))]
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOCS)
    found = leakage.paraphrased(frame, spark.createDataFrame([(7, item, "x")], ITEMS)).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 7)] and found[0]["lcs_share"] >= 0.6


def test_lcs():
    assert leakage.lcs([1, 2, 3, 4], [2, 9, 4]) == 2 and leakage.lcs([], [1]) == 0
