import collections

import duckdb
import pytest

from lakeloom.llm import queries
from tests.llm.conftest import SMALL

TABLES = "documents pages benchmark labels".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    got = collections.Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert got == collections.Counter(want.fetchall())
