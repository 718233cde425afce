"""Filter audit and source divergence against plain Python, with nulls, repeats, clashing names and empty tables."""

import re
from collections import Counter, defaultdict
from itertools import permutations

from citeloom.llm import divergence, queries
from citeloom.llm.filters import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def audit(docs, labels):
    """Each order is run over each document, one filter after another."""
    first, out = {}, defaultdict(lambda: [0] * 7)
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for i, text, source in docs:
        text = text or ""
        words = WORD.findall(text)
        failed = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None, "E": text in first and (i is None or i > first[text]),
        }
        for order in permutations("ABCDE"):
            there = True
            for step, x in enumerate(order, 1):
                n = out[source or "", "".join(order), step]
                removed = there and failed[x]
                for k, add in enumerate((there and not removed, removed, not there and failed[x], [k for k, v in failed.items() if v] == [x], removed and i in good, removed and i in toxic)):
                    n[k] += add
                there = there and not removed
    shapley = Counter()
    for (part, order, step), n in out.items():
        shapley[part, order[step - 1]] += n[1]
    return sorted((*k, *n[:6], shapley[k[0], k[1][k[2] - 1]]) for k, n in out.items())


def test_filter_audit_of_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert sorted(map(tuple, queries.op11_filter_audit(spark, sf).collect())) == audit(docs, labels)


def test_filter_audit_of_hard_rows(spark):
    many = " ".join(f"w{i}" for i in range(250))
    docs = [
        (1, many, "a"), (1, many, "a"), (2, many, "b"), (3, None, None), (4, "", "a"), (None, many, "a"), (None, "only here", "a"), (None, "only here", "b"),
        (5, "A B # c", "a"), (6, "x " * 100_000, "c"), (7, "é" * 60 + " ABC", "a"), (8, many + " #\x0bX y", "a"), (8, many.upper(), "b"), (9, "\n\t \r", None),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (4, None, 1), (None, 1, 1), (5, 1, 1), (6, 1, 0), (99, 1, 1)]
    frame = spark.createDataFrame([(*r, 1, "k") for r in docs], "doc_id long, text string, source string, failed int, part string")
    known = spark.createDataFrame([(*r, 2) for r in labels], "doc_id long, quality int, toxic int, good int")
    assert sorted(map(tuple, filter_audit(frame.repartition(3), known).collect())) == audit(docs, labels)
    assert filter_audit(frame.limit(0), known).collect() == []
    assert sorted(map(tuple, filter_audit(frame, known.limit(0)).collect())) == audit(docs, [])


def spread(docs, least, most):
    """Every share of every term, and their differences."""
    counts, within = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang or "", source or ""].update(terms)
        within[lang or ""].update(set(terms))
    out = []
    for lang, n_docs in within.items():
        kept = [t for t, n in n_docs.items() if n >= least]
        shares = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}  # noqa: E731, B023
        sources = [s for x, s in counts if x == lang]
        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            parts = {
                "pair": [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s],
                "term": [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]],
            }
            for part, found in parts.items():
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(sorted(found), 1) if part == "pair" or i <= most]
    return sorted(out)


def test_divergence_of_hard_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    docs = [("The the ÉTÉ été x1y", "en", "a"), ("the Cat", "en", "b"), ("the cat sat sat", "en", "c"), ("", "en", "d"), (None, None, None), ("cat\x00é_é", "en", ""), ("cat été", "en", "ü"), ("the " * 50_000, "en", "b")]
    docs += [("lone", "fr", "a"), ("zz", "de", "a"), ("zz", "de", "b"), ("the cat", "en", "a"), ("the cat", "en", "a"), ("rare", "en", None)]
    frame = spark.createDataFrame([(*r, i, i) for i, r in enumerate(docs)], "text string, lang string, source string, rank int, value int").repartition(3)
    for least, most in ((2, 50), (1, 2), (30, 50)):
        assert sorted(map(tuple, divergence.divergence(frame, least, most).collect())) == spread(docs, least, most)
    assert divergence.divergence(frame.limit(0)).collect() == []


def test_divergence_of_many_sources(spark):
    """Sources of very different sizes, so that a posting can be under another source's share of nothing."""
    docs = [(" ".join(f"t{chr(97 + (i * k) % 23)}" for k in range(1 + i % 9 * 20)), "en" if i % 5 else "fr", f"s{i * i % 31}") for i in range(400)]
    frame = spark.createDataFrame(docs, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.divergence(frame, 30, 5).collect())) == spread(docs, 30, 5)
