"""Web pages: headings, paragraphs and next links, and the frontier of absolute links in the order they were first seen.

All of it is expressions over the page's row. Links are resolved by the steps of RFC 3986, with the habits of
Python's urljoin where it differs: empty segments of a relative path go, a reference with an authority is left as it is, and empty queries and fragments go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What is no text, and the characters that entities stand for.
UNSEEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\xa0", "&copy;": "©", "&middot;": "·", "&amp;": "&"}
#: A paragraph ends at its end tag, at the next paragraph, or with what holds it.
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>(.*?)(?=</p\s*>|<p[\s>]|</(?:article|section|div|main|body|html)\s*>|\z)"
HEADING = r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>"
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""
NEXT = r"""(?is)class\s*=\s*["'](?:[^"']*\s)?next(?:\s[^"']*)?["'][^>]*>\s*<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def unescaped(text: Column) -> Column:
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def shown(html: Column) -> Column:
    """The text of a piece of HTML: what stands between its tags, each part without white space at its ends, joined."""
    parts = F.split(html, r"(?s)<[^>]*>", -1)
    return F.array_join(F.transform(parts, lambda x: F.regexp_replace(unescaped(x), r"(?U)^\s+|\s+$", "")), "")


def split_url(url: Column) -> dict[str, Column]:
    """scheme, authority, path, query and fragment of a URL, empty where there is none."""
    rest = F.regexp_replace(url, SCHEME, "")
    tail = F.regexp_replace(rest, "^//[^/?#]*", "")
    return {
        "scheme": F.lower(F.regexp_extract(url, SCHEME, 1)), "authority": F.regexp_extract(rest, "^//([^/?#]*)", 1), "path": F.regexp_extract(tail, "^([^?#]*)", 1),
        "query": F.regexp_extract(tail, r"^[^?#]*\?([^#]*)", 1), "fragment": F.regexp_extract(tail, "(?s)#(.*)$", 1),
    }


def without_dots(segments: Column) -> Column:
    """The path of segments: `.` stays where it is and `..` goes back, at most to the root."""
    none = F.array().cast("array<string>")

    def step(acc: Column, s: Column) -> Column:
        return F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))

    path = F.array_join(F.aggregate(segments, none, step), "/")
    # a last dot leaves a folder
    folder = F.concat(F.aggregate(segments, none, step), F.array(F.lit("")))
    path = F.when(F.element_at(segments, -1).isin(".", ".."), F.array_join(folder, "/")).otherwise(path)
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def absolute(base: Column, link: Column) -> Column:
    """link as seen from the page at base (http or https). Null if either is; an empty link is the page itself; other schemes are left as they are."""
    clean = F.regexp_replace(F.regexp_replace(link, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    b, u = split_url(base), split_url(clean)
    middle = lambda s: F.concat(F.slice(s, 1, 1), F.filter(F.slice(s, 2, F.greatest(F.size(s) - 2, F.lit(0))), lambda x: x != ""), F.slice(s, -1, 1))
    own, parts = F.split(u["path"], "/", -1), F.split(b["path"], "/", -1)
    folders = F.when(F.element_at(parts, -1) != "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    joint = F.concat(folders, own)
    segments = F.when(u["path"].startswith("/"), own).when(F.size(joint) > 1, middle(joint)).otherwise(joint)
    bare = u["path"] == ""
    path = F.when(bare, b["path"]).otherwise(without_dots(segments))
    query = F.when(bare & (u["query"] == ""), b["query"]).otherwise(u["query"])

    def whole(authority: Column, path: Column, query: Column) -> Column:
        some = lambda mark, x: F.when(x != "", F.concat(F.lit(mark), x)).otherwise("")
        return F.concat(b["scheme"], F.lit("://"), authority, path, some("?", query), some("#", u["fragment"]))

    foreign = (u["scheme"] != "") & (u["scheme"] != b["scheme"])
    return F.when(link == "", base).when(foreign, link).when(u["authority"] != "", whole(u["authority"], u["path"], u["query"])).otherwise(whole(b["authority"], path, query))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, url_hash, header, paragraphs, next_url) of each page; header and next_url are null where there is none, and a null page has no paragraphs."""
    html = F.regexp_replace(F.coalesce("html", F.lit("")), UNSEEN, "<!>")
    one = lambda rx: F.get(F.regexp_extract_all(html, F.lit(rx), F.lit(1)), 0)
    paragraphs = F.transform(F.regexp_extract_all(html, F.lit(PARAGRAPH), F.lit(1)), shown)
    return pages.select("page_id", "url", F.substring(F.sha2("url", 256), 1, 16).alias("url_hash"), shown(one(HEADING)).alias("header"), paragraphs.alias("paragraphs"), absolute(F.col("url"), unescaped(one(NEXT))).alias("next_url"))


def links(pages: DataFrame, contains: str = "") -> DataFrame:
    """(page_id, place, link, url): every link of a page whose text has `contains`, with its place from 0 and its absolute URL."""
    html = F.regexp_replace("html", UNSEEN, "<!>")
    found = pages.select("page_id", F.col("url").alias("base"), F.posexplode(F.regexp_extract_all(html, F.lit(HREF), F.lit(1))).alias("place", "raw"))
    found = found.withColumn("link", unescaped(F.col("raw"))).where(F.contains("link", F.lit(contains)))
    return found.select("page_id", "place", "link", absolute(F.col("base"), F.col("link")).alias("url"))


def frontier(pages: DataFrame, visited: DataFrame | None = None, contains: str = "") -> DataFrame:
    """(url, page_id, place, n_pages): each URL that pages link to, once, with where it was first seen; by page_id and place, these are in the order of a crawl.

    visited: (url) of pages that are left out. One aggregation by URL, with what a task has summed before.
    """
    seen = links(pages, contains).groupBy("url", "page_id").agg(F.min("place").alias("place"))
    first = seen.groupBy("url").agg(F.min(F.struct("page_id", "place")).alias("first"), F.count("*").alias("n_pages"))
    first = first.select("url", "first.page_id", "first.place", "n_pages").where("url IS NOT NULL")
    return first if visited is None else first.join(visited.select("url").distinct(), "url", "left_anti")


def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs as rows, as a page may have many."""
    found = extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url_hash", "header", F.posexplode("paragraphs").alias("place", "paragraph"))


def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is linked and is not a page yet."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return frontier(pages, pages.select("url"))


PROGRAMS = {"s10_paragraphs": s10, "s11_frontier": s11}
