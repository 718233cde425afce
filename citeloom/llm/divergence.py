"""Source divergence audit: how far the sources of a language differ in their words, and by which words.

An inverted index has, for each kept term of a language, its postings: the sources that use it. A pair of sources
starts at V times the difference that a term gives which neither uses; postings then correct that sum, and only
where a correction is not zero. For a term, let p and q be the two shares and p0 and q0 those of a count of zero.
Then |p - q| = |p0 - q0| + (|p - q0| - |p0 - q0|) + (|p0 - q| - |p0 - q0|) + what only a term of both adds. The
two brackets depend on one source's posting and the other's p0 alone, so they come from sums by source; the last
part is summed, for blocks of terms, by source against source, so that no pair is emitted for a single term.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import cut, ship, small_side

TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Shares are whole numbers of billionths; each count is raised by RAISED.
WHOLE, RAISED = 1_000_000_000, 5
#: Different terms that a task counts before it hands them on, sources that meet in a tile of a block, and postings of a block.
HELD, TILE, BLOCK = 400_000, 512, 200_000
#: Parts that the pairs of a language are dealt in.
DEALT = 16


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs), summed over each task's documents as far as HELD allows.

    A term is a run of letters A-Z, lower-cased, or of characters past ASCII: in UTF-8, bytes of a to z or of 128 and more.
    """
    ship(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], Counter] = {}
        within: dict[tuple[str, str], Counter] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for key, counts in total.items():
                n = len(counts)
                terms = pa.array([t.decode("utf-8", "replace") for t in counts], pa.string())
                counted = (pa.array(x, pa.int64()) for x in (list(counts.values()), list(within[key].values())))  # both met their terms in one order
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.string()), terms, *counted], names=["lang", "source", "term", "n", "n_docs"])
            total.clear()
            within.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Counter(TERM.findall(text.lower()))
                total.setdefault((lang, source), Counter()).update(counts)
                within.setdefault((lang, source), Counter()).update(dict.fromkeys(counts, 1))
            if sum(map(len, total.values())) >= HELD:
                yield from handed()
        yield from handed()

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")), text.alias("text"))
    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, n_docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def postings(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, uses): the inverted index of the terms in least_docs documents of a language or more; uses: (source, n) of each source that has the term."""
    index = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.collect_list(F.struct("source", "n")).alias("uses"))
    return index.where(F.col("n_docs") >= least_docs).select("lang", "term", "uses")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(WHOLE * (n + RAISED) / (total + RAISED * kept)), exactly: decimals hold what 64 bits would not."""
    big = "decimal(30,0)"
    return F.when(total + RAISED * kept > 0, F.call_function("div", (n + RAISED).cast("decimal(20,0)") * F.lit(WHOLE).cast("decimal(10,0)"), (total + RAISED * kept).cast(big)) + 1)


def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, more) with a before b: of the terms that both have, the sum of |p - q| - |p - q0| - |p0 - q| + |p0 - q0|. In: lang and the uses (source, p, p0) of a term."""

    def of(lang: str, uses: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        flat = pa.concat_arrays(uses)
        entries = flat.flatten()
        source, p, p0 = (entries.field(i) for i in range(3))
        names = sorted(set(source.to_pylist()), key=str.encode)
        at = {x: i for i, x in enumerate(names)}
        s = np.fromiter((at[x] for x in source.to_pylist()), np.int64, len(source))
        term = np.repeat(np.arange(len(flat)), np.diff(flat.offsets.to_numpy()))
        p, p0 = p.to_numpy(), p0.to_numpy()
        zero = np.zeros(len(names), np.int64)
        zero[s] = p0
        order = np.argsort(s, kind="stable")
        upto = np.searchsorted(s[order], np.arange(len(names) + 1))
        for low in range(0, len(names), TILE):  # columns of a dense block: terms by a tile of sources
            wide = np.full((len(flat), min(TILE, len(names) - low)), -1, np.int64)
            mine = (s >= low) & (s < low + TILE)
            wide[term[mine], s[mine] - low] = p[mine]
            z = zero[low : low + TILE]
            for a in range(min(low + wide.shape[1], len(names))):
                rows = order[upto[a] : upto[a + 1]]
                q = wide[term[rows]]
                mine_p = p[rows][:, None]
                more = np.abs(mine_p - q) - np.abs(mine_p - z) - np.abs(zero[a] - q) + np.abs(zero[a] - z)
                more[q < 0] = 0
                sums = more.sum(axis=0)
                found = np.flatnonzero((sums != 0) & (np.arange(len(z)) + low > a))
                if len(found):
                    columns = [[lang] * len(found), [names[a]] * len(found), [names[low + j] for j in found]]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(sums[found])], names=["lang", "a", "b", "more"])

    held: dict[str, list[pa.Array]] = {}
    size: Counter = Counter()
    for batch in batches:
        langs = batch.column(0).to_pylist()
        cuts = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i < j:
                part = batch.column(1).slice(i, j - i)
                part = pa.ListArray.from_arrays(pa.array(part.offsets.to_numpy() - part.offsets[0].as_py(), pa.int32()), part.flatten())
                held.setdefault(langs[i], []).append(part)
                size[langs[i]] += len(part.values)
        for lang in [x for x, n in size.items() if n >= BLOCK]:
            yield from of(lang, held.pop(lang))
            del size[lang]
    for lang, uses in held.items():
        yield from of(lang, uses)


def divergence(docs: DataFrame, least_docs: int = 30, most: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) by the module's rule, for every (lang, source) that docs have.

    Part `pair`: item is each other source of the language and value the sum of |p - q| over all kept terms, all
    ranks. Part `term`: item is each term that the source uses more than the language does (p > q), value p - q, `most`
    ranks. Ranks go by value, then by the item's bytes. A null text, lang or source is ''. Each row is a
    document, so repeated rows count each; doc_id has no part. A group without terms has its pairs, with a count of
    zero for every term; a language without kept terms has pairs of value 0 and no terms. A group alone in its language has
    no pairs. An empty table gives no rows; further columns are left out.

    The texts are read once and counted where they are read. Terms, not texts, are shuffled: by (lang, source, term),
    with sums made before, then into the index, which is written. What is broadcast is a row for each group, if
    they are counted to be few.
    """
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    index = cut(postings(term_counts(docs), least_docs))
    kept = index.groupBy("lang").agg(F.count("*").alias("kept"))
    uses = index.select("lang", "term", F.explode("uses").alias("u")).select("lang", "term", "u.source", "u.n")
    totals = groups.join(uses.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(kept, "lang", "left")
    stats = totals.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept")))
    stats = cut(stats.withColumns({"p0": F.coalesce(share(F.lit(0), F.col("total"), F.col("kept")), F.lit(0)), "whole": F.sum("total").over(Window.partitionBy("lang"))}))
    few = small_side(stats)
    shares = index.select("lang", "term", F.aggregate("uses", F.lit(0).cast("long"), lambda acc, u: acc + u["n"]).alias("n_lang"), F.explode("uses").alias("u"))
    shares = shares.select("lang", "term", "n_lang", "u.source", "u.n").join(few, ["lang", "source"])
    shares = cut(shares.select("lang", "term", "source", "p0", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("n_lang"), F.col("whole"), F.col("kept")).alias("q")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= most)
    pairs = pair_sums(shares, stats).select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(terms)


def pair_sums(shares: DataFrame, stats: DataFrame) -> DataFrame:
    """(lang, source, item, value): both directions of every two sources of a language."""
    used = shares.groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum("p").alias("sum_p"))
    own = stats.join(used, ["lang", "source"], "left").select("lang", "source", "p0", "kept", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("sum_p", F.lit(0)).alias("sum_p"))
    left = own.select("lang", "source", "p0", "kept", "n", "sum_p", F.pmod(F.xxhash64("source"), F.lit(DEALT)).cast("int").alias("deal"))
    other = own.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("n").alias("m"), F.col("sum_p").alias("sum_q"), F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("deal"))
    paired = left.join(other, ["lang", "deal"]).where(F.col("source") != F.col("item"))
    # where a posting's p is under the other's p0, its distance is not p - q0 but the opposite; such postings have few different p
    low = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    least = low.groupBy("lang", "source").agg(F.min("p").alias("least"))
    few = paired.select("lang", "source", "item", F.col("q0")).join(least, ["lang", "source"]).where("least < q0").join(low, ["lang", "source"]).where("p < q0")
    under = few.groupBy("lang", "source", "item").agg(F.sum(2 * F.col("n") * (F.col("q0") - F.col("p"))).alias("under"))
    joint = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("uses")).where("size(uses) > 1").select("lang", "uses")
    ship(shares)
    more = joint.mapInArrow(both, "lang string, a string, b string, more long").groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))
    more = more.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("e"), "more").select("lang", "e.source", "e.item", "more")
    back = under.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("under").alias("under_item"))
    keys = ["lang", "source", "item"]
    whole = paired.join(under, keys, "left").join(back, keys, "left").join(more, keys, "left")
    zero, d0 = F.lit(0), F.abs(F.col("p0") - F.col("q0"))
    one = F.col("sum_p") - F.col("n") * F.col("q0") + F.coalesce("under", zero) - F.col("n") * d0
    two = F.col("sum_q") - F.col("m") * F.col("p0") + F.coalesce("under_item", zero) - F.col("m") * d0
    return whole.select(*keys, (F.col("kept") * d0 + one + two + F.coalesce("more", zero)).alias("value"))
