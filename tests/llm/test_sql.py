import collections

import pytest

from poiloom.llm import queries as Q

DATA = "/root/testdata/sf0.001"


def normal(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    df = Q.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    own = collections.Counter(tuple(map(normal, r)) for r in df.select(*columns).collect())
    sql = con.sql(Q.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    assert own == collections.Counter(tuple(map(normal, r)) for r in sql.select(", ".join(columns)).fetchall())
