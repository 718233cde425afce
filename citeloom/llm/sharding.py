"""Sharding by jump consistent hashing (Lamping and Veach): no ring table, and minimal movement when shards are appended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The generator's published multiplier, in limbs of 22, 22 and 20 bits so that no product overflows.
MULTIPLIER = 2862933555777941757
LIMB = (1 << 22) - 1
TOP = (1 << 20) - 1
C0, C1, C2 = MULTIPLIER & LIMB, (MULTIPLIER >> 22) & LIMB, MULTIPLIER >> 44
#: The jumps grow geometrically; over 2**31 shards, 80 of them are passed with a probability under 1e-20, and the chain ends there.
MOST_JUMPS = 80


def jump_shards(key: Column, n_shards: int) -> Column:
    """struct(shard, grown): the shard of a long key among n_shards and among n_shards + 1."""
    if not 1 <= n_shards < 2**31 - 1:
        raise ValueError("n_shards is 1 to 2**31 - 2")
    long = lambda x: F.lit(x).cast("long")

    def step(s: Column, _: Column) -> Column:
        t0 = s["k0"] * C0 + 1
        t1 = s["k0"] * C1 + s["k1"] * C0 + F.shiftrightunsigned(t0, 22)
        t2 = s["k0"] * C2 + s["k1"] * C1 + s["k2"] * C0 + F.shiftrightunsigned(t1, 22)
        k1, k2 = t1.bitwiseAND(long(LIMB)), t2.bitwiseAND(long(TOP))
        draw = F.shiftleft(k2, 11).bitwiseOR(F.shiftrightunsigned(k1, 11)) + 1
        # (b + 1) * (2**31 / draw), in whole numbers
        jump = F.call_function("div", F.shiftleft(s["j"] + 1, 31), draw)
        on = F.struct(
            t0.bitwiseAND(long(LIMB)).alias("k0"), k1.alias("k1"), k2.alias("k2"),
            F.when(s["j"] < n_shards, s["j"]).otherwise(s["shard"]).alias("shard"), s["j"].alias("grown"), jump.cast("long").alias("j"),
        )
        return F.when(s["j"] <= n_shards, on).otherwise(s)

    first = F.struct(
        key.bitwiseAND(long(LIMB)).alias("k0"), F.shiftrightunsigned(key, 22).bitwiseAND(long(LIMB)).alias("k1"), F.shiftrightunsigned(key, 44).alias("k2"),
        long(0).alias("shard"), long(0).alias("grown"), long(0).alias("j"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(min(n_shards + 1, MOST_JUMPS))), first, step, lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))


def shard_documents(docs: DataFrame, n_shards: int, buckets: int = 256) -> DataFrame:
    """Each row's shard by its doc_id, with a gapless slot in the shard.

    Law `key`: doc_id and the shard count decide; of n_shards + 1 shards, only the new one takes rows. Slots
    are numbered in two levels, so no task holds a shard: rows are ranked within one of `buckets` hash buckets
    of a shard, and each bucket starts where the ones before it end. The starts are n_shards * buckets rows
    at most, whatever the input, and are broadcast.

    A null doc_id counts as key 0; a null text is empty (size 8, CRC 0). Rows of one doc_id share a shard and
    have slots of their own. An empty table gives an empty result; further columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        jump_shards(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), n_shards).alias("to"),
        F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("bucket"),
    ).select("doc_id", "size", "text_crc32", F.col("to.shard").alias("shard"), F.col("to.grown").alias("grown_shard"), "bucket")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("rank", F.row_number().over(within))
        .join(F.broadcast(starts), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard")
    )
