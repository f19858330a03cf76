import duckdb
import pytest

from quernstone.llm import queries
from quernstone.session import TABLES


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    assert sorted(map(key, map(tuple, got.select(*columns).collect()))) == sorted(map(key, want.fetchall()))
