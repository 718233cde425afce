"""Exact substring dedup over bytes by suffix arrays, sharded by content.

A window of WIDTH bytes belongs to the shard of its minimizer, the smallest hash of the k-byte strings in it.
It depends on the window's bytes alone, so equal windows meet in one shard whatever their documents; runs of
windows with one minimizer travel together. Copies of a whole run are one before they are sorted: runs first
travel as 64-bit hashes, and of equal ones those of all but the smallest document go. Only where documents share
a minimizer in different runs, the bytes of one run of each kind, its snippet, are dealt to the shard.

A shard gets a suffix array by Larsson and Sadakane's refinement and the common prefixes by Kasai's pass, side by
side over its snippets; windows are equal if they are neighbours with a common prefix of WIDTH or more. A shard
larger than a block has several arrays, in order of doc_id: a block's windows are found by binary search in the
sorted windows of those before it, which are merged when they are of like size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import cut, ship, small_side
from citeloom.llm.hashing import BASE, INVERSE, mix, powers
from citeloom.llm.jaccard import as_long, chunks

#: Bytes of a window, and of the strings of which the smallest hash decides its shard.
WIDTH, K = 50, 20
#: Snippet bytes in one suffix array, bytes that its first sort takes, and windows of a run at most: longer ones, of periodic texts, are parted.
BLOCK, FIRST, LONGEST = 400_000, 7, 64


def numbered_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, minimizer, content) of each run of windows with one minimizer; content is a hash of the run's bytes. Windows do not cross texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    n = len(data) - WIDTH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), BASE), out=total[1:])
    low = mix((total[K:] - total[:-K]) * powers(len(total) - K, INVERSE))
    span, step = WIDTH - K + 1, 1
    while step < span:  # minima of ever wider ranges
        more = min(step, span - step)
        low = np.minimum(low[:-more], low[more:])
        step += more
    text = np.repeat(np.arange(len(texts)), sizes)[:n]
    inside = np.arange(n) + WIDTH <= starts[text + 1]
    new = inside & np.concatenate(([True], (low[1:] != low[:-1]) | ~inside[:-1] | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    ends = np.flatnonzero(inside & np.concatenate((new[1:] | ~inside[1:], [True])))
    parts = (ends - first) // LONGEST + 1
    lead = np.repeat(first, parts) + LONGEST * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    first, ends = lead, np.minimum(lead + LONGEST - 1, np.repeat(ends, parts))
    count = ends - first + 1
    raw = (total[ends + WIDTH] - total[first]) * powers(len(total), INVERSE)[first]
    at = text[first]
    return at, first - starts[at], count, low[first], mix(raw + count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return numbered_runs(texts)[:4]


POSTS = "at long, key long, content long, doc long, start long, size long, many boolean"


def posts_batch(at, key, content, doc, start, size, many) -> pa.RecordBatch:  # noqa: ANN001
    n = len(doc)
    known = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(as_long(x))
    return pa.RecordBatch.from_arrays([known(at), known(key), known(content), *(pa.array(x) for x in (doc, start, size)), pa.array(many)], names=["at", "key", "content", "doc", "start", "size", "many"])


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each document, with those that overlap or touch as one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    base = np.r_[0, np.cumsum(doc[1:] != doc[:-1])] * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + base)
    first = np.flatnonzero(np.r_[True, (start + base)[1:] > reach[:-1]])
    return doc[first], start[first], (reach - base)[np.r_[first[1:] - 1, len(doc) - 1]]


def posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each document, without their bytes, and where (at) they meet those of other batches.

    A run that a smaller document of the batch has too goes whole, and comes as a span without a key. Of those
    left of a minimizer, if they are of several documents, one meets the other batches (many: there are more);
    the rest are known to be shared and are dealt out. So hot minimizers are pre-aggregated.
    """
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        found = []
        for row, texts in chunks(batch, 1):
            at, first, count, low, content = numbered_runs(texts)
            found.append((low, content, ids[row + at], first, count + WIDTH - 1))
        if not found:
            continue
        key, content, doc, start, size = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(key):
            continue
        order = np.lexsort((doc, content, key))
        key, content, doc, start, size = (x[order] for x in (key, content, doc, start, size))
        lead = np.r_[True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])]
        gone = doc > doc[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        if gone.any():
            d, a, b = merged(doc[gone], start[gone], start[gone] + size[gone])
            yield posts_batch(mix(d.astype(np.uint64) ^ mix(a.astype(np.uint64))), None, None, d, a, b - a, np.zeros(len(d), bool))
        key, content, doc, start, size = (x[~gone] for x in (key, content, doc, start, size))
        lead = np.r_[True, key[1:] != key[:-1]]
        edges = np.flatnonzero(lead)
        several = (np.minimum.reduceat(doc, edges) != np.maximum.reduceat(doc, edges))[np.cumsum(lead) - 1]
        alone = several & ~lead
        yield posts_batch(np.where(alone, mix(key ^ mix(content ^ doc.astype(np.uint64))), key), key, content, doc, start, size, several)


SNIPPETS = "key long, doc long, start long, data binary"


def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (doc_id, text, runs): the bytes of each run."""
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("data", pa.binary())])
    for batch in batches:
        for row, texts in chunks(batch, 1):
            wanted = batch.column(2).slice(row, len(texts))
            doc = np.repeat(batch.column(0).to_numpy(zero_copy_only=False)[row : row + len(texts)], np.diff(wanted.offsets.to_numpy()))
            text = np.repeat(np.arange(len(texts)), np.diff(wanted.offsets.to_numpy()))
            key, start, size = (x.to_numpy(zero_copy_only=False) for x in wanted.flatten().flatten())
            data = [texts[i][a : a + n] for i, a, n in zip(text.tolist(), start.tolist(), size.tolist(), strict=True)]
            out = pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(start), pa.array(data, pa.binary())], schema=schema)
            yield out.filter(pc.greater_equal(pc.binary_length(out.column(3)), WIDTH))


def suffix_array(data: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, place of each suffix in that order) of snippets laid end to end, as Larsson and Sadakane refine it.

    ends has the end of the snippet of each byte and owner its number; a suffix ends with its snippet, and of
    equal ones that of the smaller number comes first. Suffixes are sorted by their first FIRST bytes; then, with
    h doubling, only the groups that are still equal are sorted by the place of the group of the suffix h further on.
    """
    n = len(data)
    symbols = np.concatenate((data.astype(np.int64) + 1, np.zeros(FIRST, np.int64)))
    left = ends - np.arange(n)
    key = np.zeros(n, np.int64)
    for i in range(FIRST):  # of 9 bits each; 0 behind the end
        key = key << 9 | np.where(i < left, symbols[i : i + n], 0)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    bounds = np.flatnonzero(np.r_[np.diff(key[order]) != 0, True])
    rank[order] = np.repeat(bounds, np.diff(np.r_[-1, bounds]))  # a group's number is the place of its last member
    open_ = np.flatnonzero(np.repeat(np.diff(np.r_[-1, bounds]) > 1, np.diff(np.r_[-1, bounds])))
    h, numbers = FIRST, int(owner[-1]) + 1
    while len(open_):
        members = order[open_]
        group, further = rank[members], members + h
        over = further >= ends[members]
        second = np.where(over, owner[members], rank[np.where(over, 0, further)] + numbers)
        sort = np.lexsort((second, group))
        members, group, second = members[sort], group[sort], second[sort]
        order[open_] = members
        last = np.flatnonzero(np.r_[(group[1:] != group[:-1]) | (second[1:] != second[:-1]), True])
        size = np.diff(np.r_[-1, last])
        rank[members] = np.repeat(open_[last], size)
        open_ = open_[np.repeat(size > 1, size)]
        h *= 2
    return order, rank


def common_prefixes(data: np.ndarray, base: np.ndarray, sizes: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each suffix, by its place in the text, the common prefix with the one before it in the order, as Kasai computes it.

    A suffix has at least the prefix of the suffix one byte before it, less one. The pass over the bytes of a
    snippet is sequential; all snippets go through it side by side.
    """
    ends = np.repeat(base + sizes, sizes)
    before = order[rank - 1]  # of the first in the order, the last: taken out below
    out = np.zeros(len(data), np.int64)
    longest = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[longest], -np.arange(1, int(sizes.max()) + 1), "right")
    h = np.zeros(len(sizes), np.int64)
    for step, k in enumerate(active.tolist()):
        i = base[longest[:k]] + step
        j = before[i]
        h = np.maximum(h[:k] - 1, 0)
        first = rank[i] == 0
        h[first] = 0
        room = np.minimum(ends[i] - i, ends[j] - j)
        grow = np.flatnonzero(~first & (h < room))
        while len(grow):
            grow = grow[data[i[grow] + h[grow]] == data[j[grow] + h[grow]]]
            h[grow] += 1
            grow = grow[h[grow] < room[grow]]
        out[i] = h
    return out


def packed(data: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Windows as rows of 7 numbers in the order of their bytes."""
    rows = np.zeros((len(windows), 56), np.uint8)
    rows[:, :WIDTH] = data[windows[:, None] + np.arange(WIDTH)]
    return rows.view(">u8").astype(np.uint64)


def among(sorted_rows: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The place of each row in sorted_rows, or -1, by binary search."""
    lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), len(sorted_rows), np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        a, b = sorted_rows[mid], rows[open_]
        differ = a != b
        column = differ.argmax(1)
        less = differ.any(1) & (a[np.arange(len(a)), column] < b[np.arange(len(b)), column])
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    ok = np.flatnonzero(lo < len(sorted_rows))
    found = np.full(len(rows), -1)
    same = ok[(sorted_rows[lo[ok]] == rows[ok]).all(1)]
    found[same] = lo[same]
    return found


def merged_windows(before: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Merges the last of the sorted windows of blocks, each with its smallest document, while they are of like size: a later block searches few of them."""
    while len(before) > 1 and len(before[-2][0]) <= 2 * len(before[-1][0]):
        (a, x), (b, y) = before[-2:]
        rows, docs = np.concatenate((a, b)), np.concatenate((x, y))
        order = np.lexsort((docs, *rows.T[::-1]))
        rows, docs = rows[order], docs[order]
        first = np.r_[True, (rows[1:] != rows[:-1]).any(1)]
        before[-2:] = [(rows[first], docs[first])]


def ranked_block(block: list[tuple[int, int, int, bytes]], before: list[tuple[np.ndarray, np.ndarray]], keep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of what goes of the snippets (key, doc, start, bytes) of a block; its windows join those of the blocks before if keep.

    In the suffix array, equal windows are neighbours whose common prefixes are WIDTH bytes or more.
    """
    data = np.frombuffer(b"".join(x[3] for x in block), np.uint8)
    sizes = np.array([len(x[3]) for x in block], np.int64)
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    number = np.repeat(np.arange(len(block)), sizes)
    order, rank = suffix_array(data, (base + sizes)[number], number)
    prefixes = common_prefixes(data, base, sizes, order, rank)
    kinds = np.cumsum(prefixes[order] < WIDTH) - 1
    counts = sizes - WIDTH + 1
    owner = np.repeat(np.arange(len(block)), counts)
    windows = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + base[owner]
    docs = np.array([x[1] for x in block], np.int64)[owner]
    kind = kinds[rank[windows]]
    least = np.full(int(kinds[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, kind, docs)
    gone = docs > least[kind]
    if before or keep:
        shown, first = np.unique(kind, return_index=True)
        distinct = packed(data, windows[first])  # in the order of the suffix array
        for other, other_docs in before:
            at = np.full(len(least), -1)
            at[shown] = among(other, distinct)
            gone |= (at[kind] >= 0) & (docs > other_docs[at[kind]])
        if keep:
            before.append((distinct, least[shown]))
            merged_windows(before)
    at = np.flatnonzero(gone)
    if not len(at):
        return at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
    last = np.ones(len(at), bool)
    last[:-1] = new[1:]
    place = np.array([x[2] for x in block], np.int64)[owner] + windows - base[owner]
    return docs[at[new]], place[at[new]], place[at[last]] + WIDTH


def ranked_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, start, end) of what goes, for snippets in order of key, doc and start."""
    block, size, before, key = [], 0, [], None

    def flush(keep: bool) -> Iterator[pa.RecordBatch]:
        nonlocal block, size
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ranked_block(block, before, keep)], names=["doc", "start", "end"])
            block, size = [], 0

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if row[0] != key:
                if before or size > BLOCK:
                    yield from flush(False)
                    before.clear()
                key = row[0]
            elif size > BLOCK and row[1] != block[-1][1]:
                yield from flush(True)
            block.append(row)
            size += len(row[3])
    yield from flush(False)


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The measures of rows (doc_id, text, spans)."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1), batch.column(2), strict=True):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            kept, at, gone, n, end = [], 0, 0, 0, -1
            for s in sorted((x["start"], x["end"]) for x in spans.as_py() or ()):
                if s[0] > end:
                    n += 1
                    kept.append(data[at : s[0]])
                    at = s[0]
                if s[1] > at:
                    gone += s[1] - at
                    at = s[1]
                end = max(end, s[1])
            kept.append(data[at:])
            out.append((len(data), gone, n, hashlib.sha256(b"".join(kept)).hexdigest()))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removed_spans(docs: DataFrame) -> DataFrame:
    """(doc, start, end): bytes of documents that windows of smaller documents cover; spans may overlap."""
    ship(docs)
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    of = Window.partitionBy("at")
    met = rows.mapInArrow(posts, POSTS)
    met = met.withColumns({"lo": F.min("doc").over(of), "hi": F.max("doc").over(of), "ranked": F.max("many").over(of) | (F.min("content").over(of) != F.max("content").over(of)), "met": F.max("many").over(of)}).where("key IS NULL OR lo <> hi OR met")
    judged = met.withColumn("gone", F.col("key").isNull() | (F.col("doc") > F.min("doc").over(Window.partitionBy("at", "content"))))
    judged = cut(judged.where("gone OR ranked").select("key", "doc", "start", "size", "gone"))
    wanted = judged.where("NOT gone").groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("key", "start", "size")).alias("runs"))
    dealt = rows.join(wanted, "doc_id").mapInArrow(snippets, SNIPPETS).repartition("key").sortWithinPartitions("key", "doc", "start")
    marked = cut(dealt.mapInArrow(ranked_shards, "doc long, start long, end long"))
    return marked.unionByName(judged.where("gone").select("doc", "start", (F.col("start") + F.col("size")).alias("end")))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of docs.

    Each byte goes that a string of WIDTH bytes covers which also starts in a document with a smaller doc_id;
    strings are those of the input, and overlaps count. A null text is empty. Rows of one doc_id are one
    document (they do not remove each other's bytes); those with a null doc_id take no part and stay whole.
    """
    spans = removed_spans(docs)
    by_doc = spans.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(by_doc, spans.count()), "doc_id", "left")
    return rows.mapInArrow(cleaned, f"doc_id long, {RESULT}")
