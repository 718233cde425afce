"""References of rules whose ids repeat, as they do from 17,400 suppliers on."""

import duckdb
from pyspark.sql import functions as F

from citeloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_rules_of_one_id(spark, tmp_path):
    for table, key in (("supplier", "s_suppkey"), ("part", "p_partkey")):
        df = spark.read.parquet(f"{SF}/{table}.parquet").where(F.col(key) <= 40)
        df.unionByName(df.withColumn(key, F.col(key) + 17_400)).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    for table in ("supplier", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = sorted(tuple(r) for r in QUERIES["o21_rule_references"](spark, str(tmp_path)).collect())
    assert got == sorted(con.execute(ORACLES["o21_rule_references"]).fetchall())
    assert len(got) < con.execute("SELECT count(*) FROM supplier").fetchone()[0]
