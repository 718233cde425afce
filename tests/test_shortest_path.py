"""Shortest paths of any length, by breadth-first search in plain Python."""

import random

from pyspark.sql import functions as F

from citeloom.operators import graph
from citeloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def brute(edges):
    out, best = {}, {}
    for a, b in edges:
        if a != b:
            out.setdefault(a, set()).add(b)
    for start in out:
        level, paths = [start], {start: start}
        hops = 0
        while level:
            hops += 1
            found = {}
            for x in sorted(level):  # of the sections a step nearer, the smallest
                for y in out.get(x, ()):
                    if y not in paths:
                        found.setdefault(y, f"{paths[x]}>{y}")
            paths |= found
            best |= {(start, y): (hops, p) for y, p in found.items()}
            level = list(found)
    return best


def got(df):
    rows = df.collect()
    assert len({(r.src, r.dst) for r in rows}) == len(rows)
    return {(r.src, r.dst): (r.hops, r.path) for r in rows}


def test_paths_of_any_length(spark):
    r = random.Random(5)
    line = [(f"{i:02d}", f"{i + 1:02d}") for i in range(12)]
    edges = [*line, ("12", "03"), ("05", "05"), *((f"x{r.randrange(30)}", f"x{r.randrange(30)}") for _ in range(45))]
    paths = got(graph.shortest(spark.createDataFrame(edges, "src string, dst string")))
    assert paths == brute(edges) and paths["00", "12"] == (12, ">".join(f"{i:02d}" for i in range(13)))
    assert graph.shortest(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_query(spark):
    edges = [(r.src, r.dst) for r in graph.relation(spark, SF, "edge").collect()]
    assert got(QUERIES["n13_shortest_path"](spark, SF)) == brute(edges)


def test_starts_go_in_slices(spark, monkeypatch):
    r = random.Random(6)
    edges = [(f"x{r.randrange(20)}", f"x{r.randrange(20)}") for _ in range(50)]
    fronts = []
    whole = graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: fronts.append(whole(df)) or fronts[-1])
    monkeypatch.setattr(graph, "STEPS_AT_ONCE", 300)
    assert got(graph.shortest(spark.createDataFrame(edges, "src string, dst string"))) == brute(edges)
    starts = [{x["from"] for x in f.select("from").collect()} for f in fronts if "hops" in f.columns]
    assert all(len(x) < 20 for x in starts) and len({a for a, _ in edges}) > max(map(len, starts))


def test_a_level_lies_by_its_starts(spark, monkeypatch):
    """What one start finds is in one task, so that the steps to one section are reduced there; nor are all sections numbered in one task."""
    r = random.Random(7)
    edges = [(f"x{r.randrange(40)}", f"x{r.randrange(40)}") for _ in range(160)]
    fronts, plans = [], []
    whole = graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or fronts.append(whole(df)) or fronts[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(graph.shortest(spark.createDataFrame(edges, "src string, dst string"))) == brute(edges)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    levels = [f for f in fronts if "hops" in f.columns and not f.isEmpty()]
    assert len(levels) > 2 and max(f.select(F.input_file_name()).distinct().count() for f in levels) > 1
    assert all(f.select("from", F.input_file_name().alias("file")).distinct().groupBy("from").count().where("count > 1").isEmpty() for f in levels)
    assert not any("windowspecdefinition(section" in p for p in plans)
