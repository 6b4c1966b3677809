import numpy as np

from siltstone.operators import search, vector_index

ROWS = "chunk_id long, embedding array<float>, cell_name string"


def test_recall_against_exact_search(spark, tmp_path):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16))
    vectors = [(c + 0.5 * rng.standard_normal(16)).tolist() for c in centres for _ in range(50)]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(5000, None, "x"), (5001, [0.0] * 16, "x"), (5002, [float("nan")] * 16, "x"), (5003, [1.0], "x")]
    indexed, centroids = vector_index.built(spark.createDataFrame(rows, ROWS), 16)
    indexed.write.parquet(str(tmp_path / "v"))
    indexed = spark.read.parquet(str(tmp_path / "v"))
    assert indexed.count() == len(rows) and indexed.filter("cell is null").count() == 4
    hits = total = 0
    for q in vectors[::100]:
        exact = {r["chunk_id"] for r in search.top_k(indexed, q, 10).collect()}
        hits += len(exact & {r["chunk_id"] for r in vector_index.top_k(indexed, centroids, q, 10).collect()})
        total += 10
        sure = vector_index.top_k(indexed, centroids, q, 10, exact=True)
        assert {r["chunk_id"] for r in sure.collect()} == exact
    assert hits >= 0.9 * total
    cells = centroids.count()
    assert {r["chunk_id"] for r in vector_index.top_k(indexed, centroids, vectors[7], 10, cells).collect()} == {r["chunk_id"] for r in search.top_k(indexed.filter("cell is not null"), vectors[7], 10).collect()}
    plan = vector_index.top_k(indexed, centroids, vectors[0], 10)._jdf.queryExecution().executedPlan().toString()
    assert "In(cell" in plan or "cell IN" in plan or "PushedFilters: [In" in plan


def test_nothing_to_index(spark):
    for rows in ([], [(1, None, "x"), (2, [0.0] * 4, "x")]):
        indexed, centroids = vector_index.built(spark.createDataFrame(rows, ROWS), 4)
        assert indexed.count() == len(rows) and centroids.count() == 0
        assert vector_index.top_k(indexed, centroids, [1.0] * 4).count() == 0
