"""Registered queries against their DuckDB statements: names, types and rows."""

import duckdb
import pytest

from titlelens.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == {n: str(t) for n, t in zip(want.columns, want.types, strict=True)}
    rows = got.select(*want.columns).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(want.fetchall(), key=repr)
