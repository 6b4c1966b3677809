from collections import Counter
from pathlib import Path

import duckdb
import pytest

from compare import plain
from siltstone.llm import queries as Q

COLUMNS = {
    "p2_found": ["chunk_id_a", "chunk_id_b"], "p3_found": ["extract_id"], "p4_found": ["page_id", "block_no"], "p5_found": ["extract_id", "line_no"], "p6_found": ["extract_id", "item_no"],
    "p7_found": ["extract_id", "segment_no", "lang"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query(spark, base, name):
    df = Q.queries()[name](spark, base)
    rows = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
        assert len({str(r) for r in rows}) == len(rows)
    sql = Q.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for p in Path(base).glob("*.parquet"):
            con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
        cursor = con.execute(sql)
        heads = [d[0] for d in cursor.description]
        theirs = Counter(tuple(plain(r[heads.index(c)]) for c in df.columns) for r in cursor.fetchall())
        assert Counter(tuple(plain(r[c]) for c in df.columns) for r in rows) == theirs
