import duckdb
import pytest

from tidewire.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    result = con.execute(queries.ORACLE[name])
    assert [d[0] for d in result.description] == got.columns
    assert sorted(map(str, result.fetchall())) == sorted(str(tuple(r)) for r in got.collect())


def test_every_operator_has_a_query():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
