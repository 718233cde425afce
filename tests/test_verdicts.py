"""Comparable verdicts against all pairs in plain Python, with a county that has most of them, ties, nulls and repeats."""

import random

from citeloom.operators import verdicts as v

CLAIM = "claim_id int, county string, severity string, liability string, injuries array<string>, impairment boolean"
VERDICT = "verdict_id int, kind string, county string, severity string, liability string, injuries array<string>, impairment boolean, year int"


def tables(seed=5):
    rng = random.Random(seed)
    county = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    severity = lambda: rng.choice([*v.SEVERITIES, None, "odd"])
    injuries = lambda: rng.choice([None, [], ["x"], ["x", "y"], ["y", "z", "w"]])
    liability = lambda: rng.choice(["clear", "strong", "disputed", None])
    claims = [(i, county(), severity(), liability(), injuries(), rng.choice([True, False, None])) for i in range(60)]
    found = [(i, rng.choice([v.KIND, v.KIND, "other", None]), county(), severity(), liability(), injuries(), rng.choice([True, False, None]), rng.choice([2018, 2019, 2022, 2024, None])) for i in range(400)]
    return claims, found


def expected(claims, found, limit):
    out = {}
    for c in claims:
        rows = [r for r in found if r[1] == v.KIND and None not in (r[7], c[1]) and r[7] >= 2019 and r[2] == c[1] and c[2] in v.SEVERITIES and r[3] in v.SEVERITIES and abs(v.SEVERITIES.index(c[2]) - v.SEVERITIES.index(r[3])) <= 1]
        key = (lambda r: (r[4] == "clear", -r[7], r[0])) if c[3] in v.STRONG else (lambda r: r[0])
        out[c[0]] = [(c, r) for r in sorted(rows, key=key)[:limit]]
    return out


def score(c, r):
    mine, other = set(c[4] or []), set(r[5] or [])
    away = abs(v.SEVERITIES.index(c[2]) - v.SEVERITIES.index(r[3]))
    total = len(mine & other) / max(len(mine), 1) * 40 + (20 if away == 0 else 10) + 10
    total += 15 if c[3] is not None and c[3] == r[4] else 10 if c[3] in v.STRONG and r[4] in v.STRONG else 0
    return total + (10 if 2025 - r[7] <= 2 else 5 if 2025 - r[7] <= 5 else 0) + (5 if bool(c[5]) == bool(r[6]) else 0)


def test_band_and_similarity(spark):
    claims, found = tables()
    left, right = spark.createDataFrame([*claims, claims[3]], CLAIM), spark.createDataFrame(found, VERDICT).repartition(7)
    for limit in (4, 50, 1000):
        want = expected(claims, found, limit)
        met = v.comparables(left, right, limit)
        got = {}
        for r in sorted(met.collect(), key=lambda r: r.place):
            got.setdefault(r.claim_id, []).append(r.verdict_id)
        assert got == {k: [r[0] for _, r in rows] for k, rows in want.items() if rows}
        order = {k: [(r[0], round(score(c, r), 6)) for c, r in sorted(rows, key=lambda p: -round(score(*p), 9))] for k, rows in want.items() if rows}
        ranks = {}
        for r in sorted(v.ranked(met).collect(), key=lambda r: r["rank"]):
            ranks.setdefault(r.claim_id, []).append((r.verdict_id, r.score))
        assert ranks == order
    assert v.comparables(left.where("false"), right).count() == v.comparables(left, right.where("false")).count() == 0


def test_heads_are_cut_before_the_shuffle(spark):
    claims, found = tables()
    plan = v.comparables(spark.createDataFrame(claims, CLAIM), spark.createDataFrame(found, VERDICT).repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
