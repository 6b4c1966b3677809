from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from compare import plain
from siltstone.plans import all_oracle_sql, all_queries


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(all_queries()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, base, name):
    df = all_queries()[name](spark, base)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = all_oracle_sql().get(name)
    if not sql:
        assert ours
        return
    con = duckdb.connect()
    for p in Path(base).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    cursor = con.execute(sql)
    heads = [d[0] for d in cursor.description]
    assert sorted(heads) == columns
    order = [heads.index(c) for c in columns]
    assert ours == Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
