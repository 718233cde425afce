"""Mixing, URL rules and quality thresholds against plain Python, on whole tables."""

import re
from collections import Counter, defaultdict

from citeloom.llm import mixing, quality, urls

SF = "/root/testdata/sf0.001"


def test_schedule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0")).selectExpr("*", "1 AS lane", "2 AS bucket")
    weights, rest, size = {"src0": 5, "src1": 3, "gone": 9}, 2, 3
    rows = mixing.placed(docs, weights, rest=rest, block_rows=size).collect()
    counts = Counter(r.source for r in docs.select("source").collect())
    names = sorted(counts, key=lambda s: (s is None, s not in weights, s or ""))
    blocks, done, slots = {k: -(-counts[s] // size) for k, s in enumerate(names)}, Counter(), []
    while live := {k: weights.get(names[k], rest) for k in blocks if done[k] < blocks[k]}:
        order, i = mixing.period(live), 0
        while True:
            k = order[i % len(order)]
            slots.append((names[k], done[k]))
            done[k] += 1
            i += 1
            if done[k] == blocks[k]:
                break
    got = defaultdict(list)
    for r in rows:
        got[r.slot].append(r)
    position = 0
    for slot, (source, block) in enumerate(slots):
        assert {(r.source, r.block) for r in got[slot]} == {(source, block)}
        assert sorted(r.position for r in got[slot]) == list(range(position, position + len(got[slot])))
        position += len(got[slot])
    assert position == docs.count() == len(rows)


def test_url_rules(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = ["HTTP://A.Example.COM/EN/", "x://example.com/en/1#/fr/", "://net/es/", "http://net?x=://y.com/", "http://b.net/fr", "http://notexample.com/en/", "", "http://www.example.com/en/a?b", "ftp://É.COM/\n/z", "http://" + "a." * 5000 + "net/es/"]
    both = pages.unionByName(spark.createDataFrame([(10**9 + i, u) for i, u in enumerate(odd)] + [(None, None)], "page_id long, url string"))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = {r.page_id: r.url for r in both.collect()}
    for r in urls.filter_urls(both, urls.fit(urls.labelled_urls(spark))).collect():
        url = want[r.page_id] or ""
        host = path = ""
        if "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split(r"[/?#]", rest, maxsplit=1)[0]
            path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
            host = host.translate(low)
        fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else r.own_verdict)


def test_thresholds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = quality.quality_report(docs).collect()

    def held(v):
        e = max(v.bit_length() - 7, 0)
        return v >> e << e

    def quartiles(values):
        values = sorted(map(held, values))
        return [values[-(-len(values) * p // 100) - 1] for p in (25, 75)]

    def limits(own, lang, metric):
        (q1, q3), (l1, l3) = quartiles(own), quartiles(lang)
        spread = quality.SPREADS * max(q3 - q1, l3 - l1) or quality.METRICS[metric]
        return q1 - spread if metric in quality.TWO_SIDED else None, q3 + spread

    groups, langs = defaultdict(list), defaultdict(list)
    for r in rows:
        if not r.base_failed:
            groups[r.lang, r.source].append(r)
            langs[r.lang].append(r)
    for r in rows:
        if r.base_failed:
            assert not r.kept
            continue
        mine = groups[r.lang, r.source] if len(groups[r.lang, r.source]) >= quality.LEAST_GROUP else langs[r.lang]
        ok = True
        for m in quality.METRICS:
            lo, hi = limits([x[m] for x in mine], [x[m] for x in langs[r.lang]], m)
            ok = ok and r[m] <= hi and (lo is None or r[m] >= lo)
        assert r.kept == ok, r


def test_limits_follow_the_group(spark):
    wide = [("en", "wide", 400 + i) for i in range(200)]
    copies = [("en", "wide", 500) for _ in range(150)]
    even = [("de", "even", 500) for _ in range(200)] + [("de", "few", 900)]
    rows = spark.createDataFrame([(a, b, 0, 0, 0, c, 0) for a, b, c in wide + copies + even], ["lang", "source", *quality.METRICS])
    got = {r.source: r.limits.m_word_len for r in quality.thresholds(rows).collect()}

    def held(v):
        e = max(v.bit_length() - 7, 0)
        return v >> e << e

    values = sorted(held(c) for _, _, c in wide + copies)
    q1, q3 = (values[-(-len(values) * p // 100) - 1] for p in (25, 75))
    assert q3 > q1
    assert (got["wide"].lo, got["wide"].hi) == (q1 - quality.SPREADS * (q3 - q1), q3 + quality.SPREADS * (q3 - q1))
    least = quality.METRICS["m_word_len"]
    assert (got["even"].lo, got["even"].hi) == (held(500) - least, held(500) + least) == (got["few"].lo, got["few"].hi)


def test_alike_source_has_its_languages_range(spark):
    rows = [("en", "wide", 400 + i) for i in range(200)] + [("en", "copies", 500)] * 150
    rows = spark.createDataFrame([(a, b, 0, 0, 0, c, 0) for a, b, c in rows], ["lang", "source", *quality.METRICS])
    got = {r.source: (r.limits.m_word_len.lo, r.limits.m_word_len.hi) for r in quality.thresholds(rows).collect()}
    assert got == {"wide": (448 - 6 * 96, 544 + 6 * 96), "copies": (500 - 6 * 28, 500 + 6 * 28)}
