"""The citation graph has every pair of lines of the table that follow each other, by plain Python over its rows."""

import pyarrow.parquet as pq

from citeloom.operators import graph
from citeloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def pairs():
    lines = {}  # an order may have a line number more than once
    for r in pq.read_table(f"{SF}/lineitem.parquet").to_pylist():
        lines.setdefault((r["l_orderkey"], r["l_linenumber"]), []).append(r["l_partkey"])
    known = {r["p_partkey"] for r in pq.read_table(f"{SF}/part.parquet", columns=["p_partkey"]).to_pylist()}
    return [(x, y, n) for (o, n), xs in lines.items() for x in xs for y in lines.get((o, n + 1), [])], known


def section(k):
    return f"{101 + k * 37 % 5800}.{k % 90 + 1:02d}"


def test_edges_are_of_the_whole_table(spark):
    found, known = pairs()
    want = {(section(a), section(b)) for a, b, _ in found if a != b and a in known and b in known}
    assert {(r.src, r.dst) for r in graph.relation(spark, SF, "edge").collect()} == want


def test_strength_is_of_the_whole_table(spark):
    want = {}
    for a, b, n in pairs()[0]:
        want[a, b] = want.get((a, b), 0) + (2 if n % 5 == 0 else 1)
    assert {(r.a, r.b): float(r.strength) for r in QUERIES["n14_edge_strength"](spark, SF).collect()} == want
