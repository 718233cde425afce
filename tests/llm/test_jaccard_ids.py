"""Null and repeated ids, and lists that are hot over many partitions, against all pairs."""

import random

from citeloom.llm import jaccard
from citeloom.llm.hashing import shingle_sets


def expected(rows, k, num, den):
    """Links of all rows' texts, united by doc_id; a row's own set size."""
    sets = [set(shingle_sets([(t or "").encode()], k)[0].tolist()) for _, t in rows]
    ids = sorted({d for d, _ in rows if d is not None})
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                root[y] = x
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets, strict=True)), key=str)


def test_null_and_repeated_ids(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    base = [[word() for _ in range(60)] for _ in range(30)]
    rows = []
    for i in range(260):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 6))):
            w[rng.randrange(len(w))] = word()
        rows.append((rng.choice((None, *range(60))), rng.choice((" ".join(w), " ".join(w), " ".join(w[:2]), "", None))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for k, t in ((3, (90, 100)), (5, (8, 10))):
        got = sorted((tuple(r) for r in jaccard.jaccard_components(df, k, t).collect()), key=str)
        assert got == expected(rows, k, *t)
    kept = jaccard.keep_one_of_each(df.selectExpr("*", "1 AS gone_id"))
    assert kept.columns == ["doc_id", "text", "gone_id"] and kept.where("doc_id IS NULL").count() == df.where("doc_id IS NULL").count()


def test_hot_list_over_many_partitions(spark):
    """Near copies of one text, with a passage that every text has, over more partitions than the session's; groups over WHOLE go by their hub."""
    rng = random.Random(9)
    word = lambda: f"v{rng.randrange(5000)}"
    passage, text = [word() for _ in range(40)], [word() for _ in range(120)]
    rows = []
    for i in range(330):
        if i % 3:
            w = list(text)
            for _ in range(rng.randrange(0, 9)):
                w[rng.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(rng.randrange(5, 200))]
        rows.append((i, " ".join(passage + w if i % 2 else w + passage)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(37)
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df, 5, (8, 10)).collect()), key=str)
    assert got == expected(rows, 5, 8, 10)


def test_keys_go_by_slices(spark, monkeypatch):
    """Each written table of entries has the keys of one slice, and the links are those of all lists."""
    rng = random.Random(11)
    rows = [(rng.randrange(300), i, 0, 1, None, None) for i in range(900)]
    lists = spark.createDataFrame(rows, "key long, a long, b long, n long, ids array<long>, tags array<long>")
    tables, cut = [], jaccard.cut
    monkeypatch.setattr(jaccard, "cut", lambda df: tables.append(cut(df)) or tables[-1])
    got = {(r.a, r.b) for r in jaccard.shared_lists(lists).collect()}
    members = {}
    for key, a, *_ in rows:
        members.setdefault(key, set()).add(a)
    assert got == {(min(m), x) for m in members.values() for x in m - {min(m)}}
    slices = [{r.key for r in t.select("key").distinct().collect()} for t in tables if "long" in t.columns]
    assert len(slices) > 1 and sum(map(len, slices)) == len(set().union(*slices)) == sum(len(m) > 1 for m in members.values())
