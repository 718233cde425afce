"""The audits' SQL gives the queries' rows."""

import os

import duckdb
import pytest

from citeloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_source_divergence"])
def test_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall())
