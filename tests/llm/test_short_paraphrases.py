from siltstone.llm import leakage

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def test_short_items_short_documents_and_last_words(spark):
    words = [f"word{i}" for i in range(300)]
    short, long, late = words[:10], words[20:60], words[100:130]
    near = lambda ws, *at: [f"other{i}" if i in at else w for i, w in enumerate(ws)]
    noise = [f"noise{i}" for i in range(40)]
    docs = [
        (1, noise[:13] + near(short, 4) + noise[13:]),
        (2, near(long[:24], 7, 15)),
        (3, noise[:33] + near(late[4:], 3, 9, 14)),
        (4, near(short, 4)),
        (5, [*noise, words[4]]),
    ]
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], DOCS)
    items = spark.createDataFrame([(7, " ".join(short)), (8, " ".join(long)), (9, " ".join(late))], ITEMS)
    found = {(r["doc_id"], r["item_id"]): r["lcs_share"] for r in leakage.paraphrased(frame, items).collect()}
    assert set(found) == {(1, 7), (2, 8), (3, 9), (4, 7)}
    assert found[1, 7] == 0.9 and found[3, 9] == round(23 / 26, 3)


def test_last_window():
    ids = leakage.np.arange(30, dtype="int32")
    assert [r[0] for r in leakage.covering(ids, 26, 5).tolist()] == [0, 4]
    assert leakage.covering(ids[:3], 5, 5).tolist() == [[0, 1, 2, -1, -1]]
