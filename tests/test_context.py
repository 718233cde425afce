"""Complete contexts against plain Python: by hand on a few sections, and over all sections of a table."""

from collections import defaultdict

from citeloom.operators import context, graph

SF = "/root/testdata/sf0.001"


def expected(docs, edges, members):
    facts = {s: (t or "", u or "", len((x or "").split())) for s, t, u, x in docs}
    cites, cited, chain = defaultdict(list), defaultdict(list), defaultdict(list)
    for a, b in sorted(edges):
        cites[a].append(b)
        cited[b].append(a)
    for start, pos, s in members:
        if pos < 5:
            chain[start].append((pos, s))
    out = []
    for s in facts:
        direct = [(i, x) for i, x in enumerate(cites[s], 1) if x in facts]
        links = [(i, x) for i, x in chain[s] if x in facts]
        total = facts[s][2] + sum(facts[x][2] for _, x in direct) + sum(facts[x][2] for _, x in links if x != s)
        rows = [("primary", 0, s), ("source", 0, s), *(("direct", *x) for x in direct), *(("source", *x) for x in direct), *(("chain", *x) for x in links)]
        rows += [("reverse", None, x) for x in cited[s] if x in facts]
        out += [(s, part, pos, x, *facts[x], total if part == "primary" else None) for part, pos, x in rows]
    return sorted(out, key=repr)


def test_by_hand(spark):
    docs = [("1", "One", "u1", "a b c"), ("2", None, None, "d  e"), ("3", "Three", "u3", None), ("4", "Four", "u4", "f")]
    edges = [("1", "2"), ("1", "3"), ("1", "9"), ("2", "1"), ("9", "1"), ("9", "2")]
    members = [("1", 0, "1"), ("1", 1, "2"), ("1", 2, "9"), ("1", 5, "4"), ("9", 0, "9"), ("9", 1, "1")]
    frames = spark.createDataFrame(docs, "section string, title string, url string, text string"), spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame(members, "start string, pos int, section string")
    got = [tuple(r) for r in context.complete_context(*frames).collect()]
    assert sorted(got, key=repr) == expected(docs, edges, members)
    assert {r[0]: r[7] for r in got if r[1] == "primary"} == {"1": 3 + 2 + 0 + 2, "2": 2 + 3, "3": 0, "4": 1}
    assert context.complete_context(*(f.limit(0) for f in frames)).count() == 0


def test_over_all_sections(spark):
    docs, edges = graph.relation(spark, SF, "doc"), graph.relation(spark, SF, "edge")
    rows = [tuple(tuple(r) for r in df.collect()) for df in (docs.select("section", "title", "url", "text"), edges.select("src", "dst"), graph.n01(spark, SF).select("start", "pos", "section"))]
    got = sorted((tuple(r) for r in context.q03(spark, SF).collect()), key=repr)
    assert got == expected(*rows)
    totals = {r.section: r.total_context_words for r in context.g23(spark, SF).collect()}
    assert totals == {r[0]: r[7] for r in got if r[1] == "primary"} and len(totals) == len(rows[0])
