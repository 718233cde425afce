"""Filter interaction audit: what five filters remove, alone and in every order, by source.

A relational word pipeline: words are exploded, counted by (document, word), then by document into totals and
distincts. The other flags are outer-joined to them, and each source gets 32 conditional counts, one for each set
of filters that a document fails; all orders and steps follow from these.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import SPACES, ship
from citeloom.llm.sentencepieces import part_sizes

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
#: Of all orders, those in which a filter comes before the others that a document fails, by the number of filters it fails.
ORDERS = list(permutations(FILTERS))
FIRST_OF = [0, *(len(ORDERS) // n for n in range(1, len(FILTERS) + 1))]


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def word_counts(texts: pa.Array) -> pa.Table:
    """(row, n_words, n_distinct) of the rows that have words: words exploded, counted by (row, word), then by row."""
    words = pc.split_pattern_regex(texts, pattern=SPACES)
    each = pa.table({"row": pc.list_parent_indices(words).cast(pa.int64()), "word": pc.list_flatten(words)})
    each = each.filter(pc.not_equal(each["word"], "")).group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")])
    return each.group_by("row", use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")]).rename_columns(["row", "n_words", "n_distinct"])


def upper_letters(texts: pa.Array) -> np.ndarray:
    """How many of A to Z each text has: bytes of other characters are never in that range."""
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy())))
    data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    upto = np.concatenate(([0], np.cumsum((data >= ord("A")) & (data <= ord("Z")))))
    return np.diff(upto[ends])


def failed(texts: pa.Array) -> np.ndarray:
    """The set of A to D that each text fails, as bits."""
    row = pa.array(np.arange(len(texts)))
    flags = pa.table({"row": row, "upper": upper_letters(texts), "points": pc.utf8_length(texts), "symbols": pc.match_substring_regex(texts, "[#$%&*|]")})
    counts = word_counts(texts)
    whole = flags.join(counts, "row", join_type="left outer", use_threads=False).sort_by("row")
    n_words, n_distinct, upper, points, symbols = (pc.fill_null(whole[c], 0 if c != "symbols" else False).to_numpy() for c in ("n_words", "n_distinct", "upper", "points", "symbols"))
    tests = {"A": n_words < 200, "B": 100 * n_distinct < 50 * n_words, "C": 100 * upper > 2 * points, "D": symbols}
    return sum(np.where(test, bit(letter), 0) for letter, test in tests.items()).astype(np.int32)


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text_sha256, failed) for each row of docs: the set of A to D that it fails, as bits.

    All words of a document are in its row, so both counts are made where the row is read, by Arrow, about two
    megabytes of texts at once or one longer text: neither texts nor words are shuffled.
    """
    ship(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            row = 0
            for n in part_sizes(whole.column(3)):
                batch = whole.slice(row, n)
                row += n
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(failed(batch.column(3)))], names=["doc_id", "part", "text_sha256", "failed"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.sha2(text, 256).alias("text_sha256"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, part string, text_sha256 string, failed int")


def with_copies(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, n): how many rows of a part fail just these filters, E among them.

    A text's first doc_id is found from rows that are counted by (text, part, labels) beforehand, so that no task
    has all copies of a text.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    rows = rows.join(known, "doc_id", "left").withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
    what = ("text_sha256", "part", "failed", "good", "toxic")
    by_id = rows.groupBy(*what, "doc_id").agg(F.count("*").alias("n"))
    groups = by_id.groupBy(*what).agg(F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("n_low"))
    first = F.min("low").over(Window.partitionBy("text_sha256"))
    kept = F.when(F.col("first").isNull(), F.col("n")).when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0)
    groups = groups.withColumn("first", first).withColumn("kept", kept)
    either = F.explode(F.array(F.struct(F.col("failed").alias("failed"), F.col("kept").alias("n")), F.struct((F.col("failed") + bit("E")).alias("failed"), (F.col("n") - F.col("kept")).alias("n"))))
    return groups.select("part", "good", "toxic", either.alias("e")).select("part", "e.failed", "good", "toxic", "e.n").where("n > 0")


def conditional_counts(rows: DataFrame) -> DataFrame:
    """A row for each part: all_k, good_k and toxic_k, the documents that fail just the set k of filters."""
    of = {"all": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    return rows.groupBy("part").agg(*(F.coalesce(F.sum(F.when((F.col("failed") == k) & test, F.col("n"))), F.lit(0)).alias(f"{name}_{k}") for name, test in of.items() for k in range(SETS)))


def plan() -> Column:
    """Every order's steps: the filter's bit, the bits before it, and those up to it."""
    steps = []
    for order in ORDERS:
        before = 0
        for i, letter in enumerate(order):
            steps.append(f"struct('{''.join(order)}' AS filter_order, {i + 1} AS step, {bit(letter)} AS own, {before} AS before)")
            before |= bit(letter)
    return F.expr(f"array({', '.join(steps)})")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for each source of docs, all 120 orders and 5 steps, zeros included.

    Null texts are empty, null sources the part ''. Repeated rows count each. A row without a doc_id has no
    label, and comes after all others where copies are sought: it fails E if its text has a doc_id anywhere, and
    else does not. A document is good or toxic if any of its labels says so. An empty table gives no rows; further columns are left out.
    """
    counts = conditional_counts(with_copies(failures(docs), labels))
    wide = counts.select("part", *(F.array(*(F.col(f"{name}_{k}") for k in range(SETS))).alias(name) for name in ("all", "good", "toxic")))
    rows = wide.select("*", F.explode(plan()).alias("s")).select("*", "s.*")
    sets = F.sequence(F.lit(0), F.lit(SETS - 1))

    def total(name: str, test) -> Column:
        return F.aggregate(sets, F.lit(0).cast("long"), lambda acc, k: acc + F.when(test(k), F.get(F.col(name), k)).otherwise(0))

    def meets(k: Column, what: str) -> Column:
        return k.bitwiseAND(F.col(what)) != 0

    def lost(k: Column) -> Column:
        return meets(k, "own") & ~meets(k, "before")

    return rows.select(
        "part", "filter_order", "step",
        total("all", lambda k: ~meets(k, "own") & ~meets(k, "before")).alias("kept"), total("all", lost).alias("removed"),
        total("all", lambda k: meets(k, "own") & meets(k, "before")).alias("redundant"), total("all", lambda k: k == F.col("own")).alias("unique_fails"),
        total("good", lost).alias("good_lost"), total("toxic", lost).alias("toxic_lost"),
        F.aggregate(sets, F.lit(0).cast("long"), lambda acc, k: acc + F.when(meets(k, "own"), F.get("all", k) * F.get(F.array(*(F.lit(FIRST_OF[j.bit_count()]) for j in range(SETS))), k)).otherwise(0)).alias("shapley"),
    )
