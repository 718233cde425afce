"""Related sections with their limit, against plain Python on small graphs where some sections do not exist."""

import random
from collections import defaultdict

from citeloom.operators import graph


def expected(edges, known, most):
    cites, cited, out = defaultdict(list), defaultdict(list), set()
    for a, b in sorted(edges):
        cites[a].append(b)
        cited[b].append(a)
    for s in {x for e in edges for x in e}:
        ahead = [x for x in cites[s][:most] if x in known and x != s]
        back = [x for x in cited[s][: most - len(ahead)] if x in known and x != s and x not in ahead]
        out |= {(s, x, "cited_by_primary") for x in ahead} | {(s, x, "cites_primary") for x in back}
    return out


def test_related(spark):
    dice = random.Random(5)
    for n_edges in (0, 30, 120):
        names = [f"{i:02d}" for i in range(24)]
        edges = sorted({(dice.choice(names), dice.choice(names[:12] if dice.random() < 0.5 else names)) for _ in range(n_edges)})
        known = names[3:]
        spark.createDataFrame([(x,) for x in known], "section string").createOrReplaceTempView("node")
        spark.createDataFrame(edges, "src string, dst string").createOrReplaceTempView("edge")
        ranked = "WITH ranked_edge AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS nth FROM edge)"
        for most in (2, 5):
            got = [tuple(r) for r in spark.sql(ranked + graph.related(most)).collect()]
            assert len(got) == len(set(got)) and set(got) == expected(edges, set(known), most)
    for view in ("node", "edge"):
        spark.catalog.dropTempView(view)
