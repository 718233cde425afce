"""Substring dedup by hashing lines and sentences: of repeated passages the earliest ranked one stays, in all documents together."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import SPACES, cut, ship

#: A passage goes from so many words on; shorter ones, like licence lines and headings, may recur.
MIN_WORDS = 20

#: What ends a unit: a line break, or white space behind the end of a sentence.
BETWEEN = rf"(?<=[.!?]){SPACES}|\n"
BETWEEN_UNITS, WORDS = re.compile(BETWEEN), re.compile(r"[^\x20\x09-\x0D]+")


def normalised(unit: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(unit, SPACES, " ")))


def repeated_units(docs: DataFrame, rank: str = "doc_id") -> DataFrame:
    """(doc_id, version, gone): for each text, the numbers of its units that stand earlier in the collection. version is a hash of the text."""
    units = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col(rank).alias("rank"), F.xxhash64("text").alias("version"), F.posexplode(F.split("text", BETWEEN, -1)).alias("n", "unit"))
    units = units.withColumn("unit", normalised(F.col("unit"))).where("unit <> ''")
    units = cut(units.select(F.unhex(F.md5("unit")).alias("digest"), F.struct("rank", "doc_id", "version", "n").alias("at")))
    first = cut(units.groupBy("digest").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last").select("digest", "first"))
    again = units.join(first.hint("merge"), "digest").where("at <> first")
    return again.groupBy("at.doc_id", "at.version").agg(F.array_sort(F.collect_set("at.n")).alias("gone"))


def without(text: str, gone: set[int], min_words: int) -> tuple[str, list[tuple[int, int]], int, int]:
    """The text without its runs of repeated units of min_words or more in all, the offsets of what went, the number of units and that of those that went."""
    breaks = [(m.start(), m.end()) for m in BETWEEN_UNITS.finditer(text)]
    starts, ends, nexts = [0, *(b for _, b in breaks)], [*(a for a, _ in breaks), len(text)], [*(b for _, b in breaks), len(text)]
    spans: list[tuple[int, int]] = []
    units = removed = count = words = at = 0

    def close(end: int) -> None:
        nonlocal removed
        if count and words >= min_words:
            removed += count
            spans.append((at, end))

    end = 0
    for n, (a, b) in enumerate(zip(starts, ends, strict=True)):
        found = len(WORDS.findall(text, a, b))
        if not found:
            continue
        units += 1
        if n in gone:
            if not count:
                at = a
            count, words, end = count + 1, words + found, nexts[n]
        else:
            close(end)
            count = words = 0
    close(end)
    kept, last = [], 0
    for a, b in spans:
        kept.append(text[last:a])
        last = b
    return "".join([*kept, text[last:]]), spans, units, removed


def units_of(text: str) -> int:
    return sum(WORDS.search(x) is not None for x in BETWEEN_UNITS.split(text))


def dedup_lines(docs: DataFrame, rank: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text, n_units, n_removed, removed) for each row of docs.

    Units are lines, parted into sentences where there are some: a sentence ends with . ! or ? before white
    space. They are compared without regard to case and to the amount of white space; those without words do
    not count. Of equal units, the first by (rank, doc_id, place in the text) is the original and the others are repeats, in
    the same text too. A run of neighbouring repeats goes if it has min_words words or more; so a passage is
    found wherever it stands and whatever its line breaks, but for the sentences that are cut at its ends, and
    a short line that many texts share stays. n_units counts a text's units, n_removed those that went.
    removed has the offsets, in characters of the text as it came, of what went, with the white space after it.

    A null text stays null; rows with a null doc_id take no part and stay whole. Rows of one doc_id with one
    text are one document; with different texts, they are documents in the order of a hash of the text. A null
    rank comes first. An empty table gives an empty result; other columns are left out, and rank may be any of them.

    A unit is shuffled as a digest of 16 bytes and its place, and counted map-side, so a common line is a
    few rows. Units and the first place of repeated digests are narrow checkpoints, so texts are parted once and a hot digest
    can be split; digests and texts are joined by shuffles at any size.
    """
    ship(docs)
    gone = cut(repeated_units(docs, rank))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("version")).join(gone.hint("merge"), ["doc_id", "version"], "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                out = []
                for text, numbers in zip(batch.column(1), batch.column(2), strict=True):
                    text, numbers = text.as_py(), numbers.as_py()
                    if text is None:
                        out.append((None, [], 0, 0))
                    elif not numbers:
                        out.append((text, [], units_of(text), 0))
                    else:
                        out.append(without(text, set(numbers), min_words))
                spans = pa.array([[{"start": a, "end": b} for a, b in o[1]] for o in out], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.int64()), spans], names=["doc_id", "text", "n_units", "n_removed", "removed"])

    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text string, n_units long, n_removed long, removed array<struct<start:int,end:int>>")
