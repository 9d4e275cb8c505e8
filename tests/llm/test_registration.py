import duckdb
import pytest

import __spark_entry__ as contract
from tallyworks.llm import queries

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = contract.queries().keys()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert queries.oracle_sql().items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_twin(spark, name):
    got = contract.queries()[name](spark, SF)
    with duckdb.connect() as db:
        for table in ("pages", "documents"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        cursor = db.execute(contract.oracle_sql()[name])
        columns = [d[0] for d in cursor.description]
        want = sorted(cursor.fetchall(), key=repr)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == want
