import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.operators.snapshots import canonical_address, canonical_source, snapshot_changes

T0 = datetime(2024, 1, 1)
RUNS = "index_name string, id string, lifecycle_status string, started_at timestamp, finished_at timestamp, extra string"
ROWS = "id string, run_id string, source_id string, canonical_url string, normalized_content_hash string, created_at timestamp, seq string"


def runs(spark, n=3, extra=()):
    rows = [("i", f"r{k}", ("complete", "activated", "superseded")[k % 3], T0 + timedelta(days=k), T0 + timedelta(days=k, hours=1), "x") for k in range(n)]
    return spark.createDataFrame([*rows, *extra], RUNS)


def changes(spark, rows, n=3, extra=()):
    frame = spark.createDataFrame([(f"d{i}", r, s, u, h, T0 + timedelta(minutes=m), "clash") for i, (r, s, u, h, m) in enumerate(rows)], ROWS)
    return sorted(tuple(r) for r in snapshot_changes(frame, runs(spark, n, extra)).collect())


def test_added_changed_removed_and_moved(spark):
    rows = [("r0", "s", "https://a/1", "h1", 0), ("r0", "s", "https://a/2", "h2", 0), ("r1", "s", "https://a/1", "H1", 0), ("r1", "s", "https://a/3", "h2", 0), ("r2", "s", "https://a/1", "h9", 0)]
    assert changes(spark, rows) == [
        ("r1", "added", "s", "https://a/3", ""),
        ("r1", "moved", "s", "https://a/3", "https://a/2"),
        ("r1", "removed", "s", "https://a/2", ""),
        ("r2", "changed", "s", "https://a/1", ""),
        ("r2", "removed", "s", "https://a/3", ""),
    ]


def test_record_that_comes_back_is_added_again(spark):
    rows = [("r0", "s", "https://a/1", "h", 0), ("r0", "s", "https://a/z", "z", 0), ("r1", "s", "https://a/z", "z", 0), ("r2", "s", "https://a/1", "h", 0), ("r2", "s", "https://a/z", "z", 0)]
    assert changes(spark, rows) == [("r1", "removed", "s", "https://a/1", ""), ("r2", "added", "s", "https://a/1", "")]


def test_latest_row_of_an_identity_counts_and_missing_hashes_are_equal(spark):
    rows = [("r0", " S ", "HTTPS://A/1#top", None, 0), ("r1", "s", "https://a/1", "old", 1), ("r1", "s", "https://a/1 ", None, 2), ("r2", "s", "https://a/1", "new", 0)]
    assert changes(spark, rows) == [("r2", "changed", "s", "https://a/1", "")]


def test_runs_that_do_not_count(spark):
    extra = [("i", "bad", "rejected", T0 + timedelta(hours=30), T0 + timedelta(hours=31), "x"), ("i", "open", "complete", T0 + timedelta(hours=32), None, "x"), ("i", "r0", "complete", T0, T0 + timedelta(hours=1), "x")]
    rows = [("r0", "s", "https://a/1", "h", 0), ("bad", "s", "https://a/2", "h2", 0), ("open", "s", "https://a/3", "h3", 0), ("r1", "s", "https://a/1", "h", 0), ("r2", "s", "https://a/1", "h", 0)]
    assert changes(spark, rows, extra=extra) == []


def test_empty_tables(spark):
    assert changes(spark, []) == []
    assert snapshot_changes(spark.createDataFrame([], ROWS), spark.createDataFrame([], RUNS)).count() == 0


def test_null_keys_are_identities(spark):
    rows = [("r0", None, None, "a", 0), ("r1", None, None, "b", 0), ("r2", None, None, "b", 0)]
    assert changes(spark, rows) == [("r1", "changed", None, None, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_pairwise_comparison(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"r{k}", f"s{rnd.randint(0, 1)}", f"https://a/{rnd.randint(0, 9)}", rnd.choice(["x", "Y", "y", "z", None]), rnd.randint(0, 500)) for k in range(5) for _ in range(8)]
    rows = list({(r[0], r[4]): r for r in rows}.values())
    state = {}
    for r, s, u, h, m in rows:
        key = (r, s, u)
        if key not in state or m > state[key][1]:
            state[key] = ((h or "").lower() if h else None, m)
    want = set()
    for k in range(1, 5):
        prev = {x[1:]: v[0] for x, v in state.items() if x[0] == f"r{k - 1}"}
        cur = {x[1:]: v[0] for x, v in state.items() if x[0] == f"r{k}"}
        added, removed = cur.keys() - prev.keys(), prev.keys() - cur.keys()
        want |= {(f"r{k}", "added", *x, "") for x in added} | {(f"r{k}", "removed", *x, "") for x in removed}
        want |= {(f"r{k}", "changed", *x, "") for x in cur.keys() & prev.keys() if cur[x] != prev[x]}
        want |= {(f"r{k}", "moved", *a, b[1]) for a in added for b in removed if cur[a] is not None and cur[a] == prev[b]}
    assert set(changes(spark, rows, 5)) == want


def test_canonical_forms(spark):
    row = spark.createDataFrame([(" HTTPS://Docs.X.Example/A?Q=1#f\t", "\tABC ")], "u string, s string").select(canonical_address(F.col("u")), canonical_source(F.col("s"))).first()
    assert tuple(row) == ("https://docs.x.example/A?Q=1", "abc")
