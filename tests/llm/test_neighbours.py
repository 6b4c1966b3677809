import numpy as np
import pytest

from siltstone.llm import neighbours as N

ROWS = "chunk_id long, content_hash string, embedding array<float>, near string, leaf int"


def brute(ids, vectors, k, least):
    x = np.array(vectors, dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(x @ x.T, 12)
    pairs = set()
    for a in range(len(ids)):
        order = sorted((-s[a, b], ids[b], b) for b in range(len(ids)) if b != a)[:k]
        pairs |= {(min(ids[a], i), max(ids[a], i)) for m, i, b in order if -m >= least}
    return pairs


def clusters(seed, groups=12, each=25, noise=0.35):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, 64))
    return [(c + noise * rng.standard_normal(64)).astype(np.float32).tolist() for c in centres for _ in range(each)]


def found(spark, rows, **options):
    points = N.usable(spark.createDataFrame(rows, ROWS))
    return N.neighbours(points, **options)


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 8, "block_rows": 64}])
def test_pairs_against_brute_force(spark, options):
    vectors = clusters(1)
    rows = [(i, f"h{i}", v, "x", 0) for i, v in enumerate(vectors)]
    got = {tuple(r) for r in N.similar_pairs(found(spark, rows, k=5, least=0.85, **options), 0.85).collect()}
    want = brute(list(range(len(rows))), vectors, 5, 0.85)
    assert len(got & want) >= 0.98 * len(want) and not got - want


def test_leaves_of_more_rows_than_an_area(spark, monkeypatch):
    monkeypatch.setattr(N, "AREA_ROWS", 16)
    vectors = clusters(2, 2, 120)
    rows = [(i, f"h{i}", v, "x", 0) for i, v in enumerate(vectors)]
    got = {tuple(r) for r in N.similar_pairs(found(spark, rows, k=5, least=0.85, leaf_rows=200, block_rows=16), 0.85).collect()}
    want = brute(list(range(len(rows))), vectors, 5, 0.85)
    assert len(got & want) >= 0.98 * len(want) and not got - want


def test_equal_vectors_and_ties_go_to_smaller_ids(spark):
    one, two = [1.0] + [0.0] * 63, [0.0, 1.0] + [0.0] * 62
    rows = [(i, f"h{i}", one if i < 40 else two, "x", 0) for i in range(50)]
    got = {(r["id"], r["near"]) for r in found(spark, rows, k=5, least=0.85).collect()}
    want = {(i, j) for i in range(40) for j in [x for x in range(6) if x != i][:5]} | {(i, j) for i in range(40, 50) for j in [x for x in range(40, 46) if x != i][:5]}
    assert got == want


def test_unusable_rows_and_repeats(spark):
    good = np.random.default_rng(3).standard_normal(64).tolist()
    rows = [(5, "a", good, None, None), (3, "a", good, None, None), (3, "a", good, None, None), (7, None, [-x for x in good], None, None), (1, "z", [0.0] * 64, None, None), (2, "n", [float("nan")] + good[1:], None, None), (4, "s", good[:63], None, None), (6, "u", None, None, None), (8, "i", [float("inf")] + good[1:], None, None), (9, "m", [None] + good[1:], None, None), (None, "k", good, None, None)]
    assert sorted(r["id"] for r in N.usable(spark.createDataFrame(rows, ROWS)).collect()) == [3, 7]
    assert found(spark, []).count() == 0
    assert found(spark, rows[:1]).count() == 0


def test_chi_square_quantile():
    assert N.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=0.01)
    assert N.chi_square_quantile(0.5, 2) == pytest.approx(1.386, abs=0.01)


def test_every_row_has_a_leaf_within_its_box():
    rng = np.random.default_rng(5)
    points = rng.standard_normal((500, 8))
    tree = N.Tree(points, 16)
    leaf = tree.leaf_of(points)
    assert tree.leaves == 16 and set(leaf) == set(range(16))
    low, high = (np.array([f(points[leaf == i], axis=0) for i in range(16)]) for f in (np.min, np.max))
    assert (N.box_distance(points, low, high)[np.arange(500), leaf] == 0).all()
