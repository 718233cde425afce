"""Mixing sources to target weights by Pfair scheduling of blocks.

Each source is a lane of its own, with the weight named for it or else the default one, and is dealt in blocks. Block i of a lane with
the share w of all slots is released at floor(i / w) and due at ceil((i + 1) / w); in each slot, the released
block with the earliest deadline is placed. On one sequence this meets every deadline, so that after any
number of slots a lane is less than one block away from its share. The schedule repeats with the sum of the
integer weights, so its positions follow from one period in closed form, without a loop over blocks. When a
lane is used up, a new epoch schedules the lanes that are left by their own weights.
"""

from __future__ import annotations

import heapq
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import cut

#: The most slots of a period and the most lanes; both bound what the driver plans.
MOST_SLOTS, MOST_LANES = 100_000, 1_000


def period(weights: dict[int, int]) -> list[int]:
    """The lane of each slot of one period, by earliest deadline first; ties go to the smaller lane."""
    total = sum(weights.values())
    placed = dict.fromkeys(weights, 0)
    coming = [(0, k) for k in weights]
    heapq.heapify(coming)
    released: list[tuple[int, int]] = []
    slots = []
    for t in range(total):
        while coming and coming[0][0] <= t:
            k = heapq.heappop(coming)[1]
            heapq.heappush(released, (-(-(placed[k] + 1) * total // weights[k]), k))
        due, lane = heapq.heappop(released)
        if due <= t:
            raise AssertionError("a deadline was missed")
        placed[lane] += 1
        if placed[lane] < weights[lane]:
            heapq.heappush(coming, (placed[lane] * total // weights[lane], lane))
        slots.append(lane)
    return slots


def epochs(blocks: dict[int, int], tail: dict[int, int], weights: dict[int, int], block_rows: int) -> list[dict]:
    """For each epoch and lane: its first block, the slot and row positions at which the epoch starts, and its slots in a period.

    blocks: how many blocks each lane has; tail: rows of its last one.
    """
    done = dict.fromkeys(blocks, 0)
    slot = row = 0
    out = []
    while live := {k: weights[k] for k in blocks if done[k] < blocks[k]}:
        order = period(live)
        total = len(order)
        at: dict[int, list[int]] = {k: [] for k in live}
        for i, lane in enumerate(order):
            at[lane].append(i)
        for k in live:
            out.append({"lane": k, "first": done[k], "slot": slot, "row": row, "total": total, "at": at[k]})
        # the slot, in this epoch, of each lane's last block: the earliest of these ends the epoch
        last = {k: (blocks[k] - done[k] - 1) // live[k] * total + at[k][(blocks[k] - done[k] - 1) % live[k]] for k in live}
        end, lane = min((x, k) for k, x in last.items())
        for k in live:
            done[k] += (end + 1) // total * live[k] + sum(x < (end + 1) % total for x in at[k])
        slot += end + 1
        row += end * block_rows + tail[lane]
    return out


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; one of maps, which have no hash, as its JSON."""
    return F.xxhash64(*(F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes))


def placed(docs: DataFrame, weights: dict[str, int], rest: int = 1, block_rows: int = 16, buckets: int = 256, keep: list[str] = ()) -> DataFrame:
    """(keep..., doc_id, source, block, slot, position) for each row of docs.

    weights: slots of each named source, and rest those of each other one; null is a source too. While no source
    is used up, each is less than a block away from its share after any number of slots; from then on the same
    holds of the sources left. position is gapless from 0 and is the order of the mix. Within a lane, rows are in the order of a hash of doc_id, so
    that neighbours are mixed, and rows of one doc_id in that of a hash of all columns, so that a task that is run again gives equal
    places; they are ranked in hash buckets, so no task holds a lane. The driver gets the
    row counts of lanes by bucket, at most MOST_LANES * buckets rows; more sources than that are an error. Repeated rows and null ids
    have places of their own; an empty table gives an empty result.
    """
    others = [r.source for r in docs.select("source").where(F.col("source").isNull() | ~F.col("source").isin(*weights)).distinct().limit(MOST_LANES + 1).collect()]
    names = sorted(weights) + sorted(x for x in others if x is not None)
    lane_weights = {i: weights.get(k, rest) for i, k in enumerate(names)} | ({len(names): rest} if None in others else {})
    if len(lane_weights) > MOST_LANES or sum(lane_weights.values()) > MOST_SLOTS or min([rest, *weights.values()]) < 1:
        raise ValueError(f"{MOST_LANES} sources at most, weights of at least 1, {MOST_SLOTS} slots in all")
    lane = F.when(F.col("source").isNull(), len(names)).otherwise(F.array_position(F.lit(names).cast("array<string>"), F.col("source")) - 1).cast("int")
    rows = docs.select(*(F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)), "doc_id", "source", lane.alias("lane"), row_hash(docs).alias("tie"), F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(buckets)).cast("int").alias("bucket"))
    counts = rows.groupBy("lane", "bucket").agg(F.count("*").alias("n")).collect()
    totals: dict[int, int] = {}
    starts = []
    for r in sorted(counts):
        starts.append((r.lane, r.bucket, totals.get(r.lane, 0)))
        totals[r.lane] = totals.get(r.lane, 0) + r.n
    blocks = {k: -(-n // block_rows) for k, n in totals.items()}
    plan = epochs(blocks, {k: n - (blocks[k] - 1) * block_rows for k, n in totals.items()}, lane_weights, block_rows)
    spark = docs.sparkSession
    by_lane = {k: [tuple(p[x] for x in ("first", "slot", "row", "total", "at")) for p in plan if p["lane"] == k] for k in totals}
    lanes = spark.createDataFrame(list(by_lane.items()), "lane int, epochs array<struct<first:long,slot:long,row:long,total:long,at:array<int>>>")
    starts = spark.createDataFrame(starts, "lane int, bucket int, start long")
    within = Window.partitionBy("lane", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "tie")
    ranked = rows.withColumn("rank", F.row_number().over(within)).join(F.broadcast(starts), ["lane", "bucket"]).withColumn("rank", F.col("start") + F.col("rank") - 1)
    block = F.call_function("div", F.col("rank"), F.lit(block_rows))
    found = ranked.join(F.broadcast(lanes), "lane").withColumn("block", block).withColumn("e", F.element_at(F.filter("epochs", lambda e: e["first"] <= F.col("block")), -1))
    i = F.col("block") - F.col("e.first")
    size = F.size("e.at")
    in_epoch = F.call_function("div", i, size) * F.col("e.total") + F.get(F.col("e.at"), (i % size).cast("int"))
    return found.withColumn("in_epoch", in_epoch).select(
        *(F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep) if c not in ("doc_id", "source")), "doc_id", "source", "block",
        (F.col("e.slot") + F.col("in_epoch")).alias("slot"), (F.col("e.row") + F.col("in_epoch") * block_rows + F.col("rank") % block_rows).alias("position"),
    )


def mixed(docs: DataFrame, weights: dict[str, int], rest: int = 1, block_rows: int = 16) -> DataFrame:
    """docs in the order of the mix, as sorted ranges of position; all columns and all rows are kept.

    Texts are shuffled twice: to rank rows in their buckets, and by ranges of their position. Ranked rows are written
    between the two, so that the files of the first shuffle are gone before the second begins.
    """
    packed = docs.select("doc_id", "source", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("mix_row"))
    whole = cut(placed(packed, weights, rest, block_rows, keep=["mix_row"]).select("mix_row", "position"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = whole.repartitionByRange(n, "position").sortWithinPartitions("position")
    return ordered.select(*(F.col(f"mix_row.`{c}`").alias(c) for c in docs.columns))


def in_order(docs: DataFrame) -> DataFrame:
    """docs, the rows of Parquet files, with position: each row's place from 0 in the files, taken in the order of their numbers.

    So the order that mixed() was written in is had again; a scan alone deals files by size, not by number. docs
    that are no scan are written first. A column of docs named position gives way; other names are free, as
    rows travel in one column. The driver gets a row for each file.
    """
    place = (F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index"))
    try:
        rows = docs.select(*place)
    except AnalysisException:
        rows = cut(docs).select(*place)

    def number(path: str) -> tuple[int, str]:
        name = path.rsplit("/", 1)[-1]
        m = re.match(r"part-(\d+)", name)
        return (int(m[1]) if m else -1, name)

    starts, n = [], 0
    for r in sorted(rows.groupBy("file").agg(F.count("*").alias("n")).collect(), key=lambda r: number(r.file)):
        starts.append((r.file, n))
        n += r.n
    starts = docs.sparkSession.createDataFrame(starts, "file string, start long")
    kept = [c for c in docs.columns if c.lower() != "position"]
    return rows.join(F.broadcast(starts), "file").select(*(F.col(f"row.`{c}`").alias(c) for c in kept), (F.col("start") + F.col("index")).alias("position"))
