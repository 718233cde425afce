"""Texts and columns that are hard on a pattern or a name."""

from pyspark.sql import functions as F

from citeloom.llm.pii import pii_report
from citeloom.llm.quality import quality_filter, quality_report


def test_pii_long_runs(spark):
    n = 1_000_000
    texts = ["x@" + "a." * n, "x@" + "ab." * 4000 + "com", *(c * n for c in "0a@=:.-+ "), "1.2." * (n // 4), "4111 " * (n // 5), "password=" + "a" * n, "a@" * (n // 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii_report(docs, "k").collect()}
    assert len(found) == len(texts)
    assert found[0].text == texts[0] and found[0].n_replaced == 0
    assert found[1].n_replaced == 1
    assert all(found[i].text == texts[i] for i in range(2, 11))


def test_pii_mail_in_text(spark):
    mails = ["ann@example.com", "a.b+c@mail.example.co.uk", "x_1@a-b.org"]
    docs = spark.createDataFrame([(i, f"write to {mail}...or {mail}, soon") for i, mail in enumerate(mails)], "doc_id long, text string")
    for r in pii_report(docs, "k").collect():
        assert r.n_replaced == 2 and mails[r.doc_id] not in r.text and r.text.startswith("write to u") and "...or u" in r.text and r.text.endswith(", soon")


def test_quality_filter_keeps_clashing_columns(spark):
    words = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, words, "en", "s", 7), (2, "short", "en", "s", 8), (3, None, None, None, 9), (4, words, None, "s", None)], "doc_id long, text string, lang string, source string, q_m int")
    named = docs.select("*", *(F.col("q_m").alias(c) for c in ("q_lang", "q_raw", "limits", "whole", "m", "a.b")))
    got = quality_filter(named.unionByName(named))
    assert got.columns == named.columns
    assert sorted(tuple(r[k] for k in (0, 4, 5, 6, 7, 8, 9, 10)) for r in got.collect()) == [(1, *[7] * 7)] * 2 + [(4, *[None] * 7)] * 2
    assert {r.doc_id for r in quality_report(named).where("kept").collect()} == {1, 4}
    assert quality_filter(docs.limit(0)).count() == 0
