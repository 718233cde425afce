"""Links against urllib, and pages against the parser of Python."""

import hashlib
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import functions as F

from citeloom.operators import pages

SF = "/root/testdata/sf0.001"
BASES = ["http://a/b/c/d;p?q", "https://ex.org", "http://ex.org/", "http://ex.org/x", "http://ex.org/x/y/?k=1#f", "http://ex.org/a//b/../c"]
LINKS = [
    "g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g",
    "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y", "g?y/./x", "g?y/../x", "g#s/./x", "g#s/../x", "http:g", "HTTP://Other/x", "mailto:a@b", "  /lead", "/a\nb", "//other.org/x/../y?z#", "a//b///c", "/a//b/", "?", "#", "//",
    "/x?#", "é/ü", "javascript:void(0)", "https://ex.org/q", "tel:1", "/", "a/b/c/../../d/.",
]


def test_absolute_links(spark):
    rows = [(b, x) for b in BASES for x in LINKS] + [(None, "x"), ("http://a/b", None)]
    got = spark.createDataFrame(rows, "base string, link string").select("base", "link", pages.absolute(F.col("base"), F.col("link")).alias("url")).collect()
    assert [(r.base, r.link, r.url) for r in got if None not in (r.base, r.link) and r.url != urljoin(r.base, r.link)] == []
    assert sum(r.url is None for r in got) == 2


class Page(HTMLParser):
    """Paragraphs that end at their end tag, the next paragraph or what holds them; links in their order."""

    def __init__(self, html):
        super().__init__()
        self.links, self.paragraphs, self.heading, self.into, self.silent = [], [], None, None, False
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])
        if tag in ("p", "h1"):
            self.into = []
            if tag == "p":
                self.paragraphs.append(self.into)
            elif self.heading is None:
                self.heading = self.into
        self.silent = tag in ("script", "style")

    def handle_endtag(self, tag):
        self.silent = False
        if tag in ("p", "h1", "article", "section", "div", "main", "body", "html"):
            self.into = None

    def handle_data(self, data):
        if self.into is not None and not self.silent:
            self.into.append(data)


def text(parts):
    return None if parts is None else "".join(x.strip() for x in parts)


def test_all_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    parsed = {r.page_id: Page(r.html or "") for r in rows}
    want = sorted((r.page_id, hashlib.sha256(r.url.encode()).hexdigest()[:16], text(parsed[r.page_id].heading), i, text(p)) for r in rows for i, p in enumerate(parsed[r.page_id].paragraphs))
    assert sorted(map(tuple, pages.s10(spark, SF).collect())) == want and len(want) > 100
    first, count = {}, {}
    for r in sorted(rows):
        for i, link in enumerate(parsed[r.page_id].links):
            url = urljoin(r.url, link)
            first.setdefault(url, (r.page_id, i))
            count.setdefault(url, set()).add(r.page_id)
    known = {r.url for r in rows}
    assert sorted(map(tuple, pages.s11(spark, SF).collect())) == sorted((u, *first[u], len(count[u])) for u in first if u not in known)


def test_hard_pages(spark):
    html = '<nav class="profile next x"><a class="k" href="../p?a=1&amp;b=2">on</a></nav><h1> A <b>B</b>\n</h1><p class="x">one<!-- <p>no --> two<p>three &lt;b&gt;<br> four</p><script>"<p>no</p>"</script><div><p>five</div>six'
    rows = [(1, "http://e.org/x/y", html), (2, "http://e.org/", None), (3, None, "<a href='q'>"), (4, "http://e.org/", "")]
    got = {r.page_id: r for r in pages.extracted(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert (got[1].header, got[1].paragraphs, got[1].next_url) == ("AB", ["onetwo", "three <b>four", "five"], "http://e.org/p?a=1&b=2")
    assert [(got[i].header, got[i].paragraphs, got[i].next_url) for i in (2, 4)] == [(None, [], None)] * 2
    assert pages.links(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()[-1].url is None
    assert re.match("[0-9a-f]{16}$", got[1].url_hash)
