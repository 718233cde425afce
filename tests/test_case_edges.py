"""A case cites all other orders of its customer, by plain Python over the orders."""

import pyarrow.parquet as pq

from citeloom.operators import graph

SF = "/root/testdata/sf0.001"


def test_case_edges_are_all_other_orders(spark):
    of = {}
    for r in pq.read_table(f"{SF}/orders.parquet", columns=["o_orderkey", "o_custkey"]).to_pylist():
        of.setdefault(r["o_custkey"], set()).add(r["o_orderkey"])
    known = {r.case_id for r in graph.relation(spark, SF, "courtcase").select("case_id").collect()}
    want = {(a, b) for cases in of.values() for a in cases & known for b in cases & known if a != b}
    got = [(r.src, r.dst) for r in graph.relation(spark, SF, "case_edge").collect()]
    assert len(got) == len(set(got)) and set(got) == want
