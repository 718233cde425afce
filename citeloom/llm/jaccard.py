"""Exact Jaccard join of shingle sets, by set-relation skipping, down to its connected components.

Index lists: a set is cut by position, that is by ranges of its sorted hashes, into more blocks than two
linked sets of that size can differ in elements. So linked sets have some number of equal blocks, and a list
is kept for each block instead of each element. A set that must share c blocks with all that are linked to it
skips the c - 1 of its lists that are longest over the whole table: the rarest block shared is still among
those of both sets. (So the lists of common phrases and passages join nothing but what consists of them.)
Sizes are parted into levels, as the number of blocks must be the same for both sets; a set near the next
level has its blocks there too.

Answers: the members of a large group of candidates are compared with one hub, the elements that most of
them have. Two sets x and y whose differences from the hub are Dx and Dy share |hub| - |hub - x| - |hub - y|
+ |Dx & Dy| elements (in Dx & Dy counting those that both lack and those that both add), so that answers of
similar sets follow from small differences. Sets close enough to the hub are linked to the closest one
without any comparison. Another set x can only be linked to sets that share some number of differences with
it, which follows from its own: lists of its differences give the last, small groups, compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import components, cut, ship, small_side
from citeloom.llm.hashing import mix, shingle_sets

#: Groups of up to so many are compared whole; of larger ones, PART members at a time with their hub.
WHOLE, PART = 64, 500
#: Members whose majority is the hub of a group: it decides the work, not the result.
ASKED = 64
#: Members in a side of a tile, when groups are compared whole.
SIDE = 128
#: Slices of the keys of lists, one of which is shuffled at a time: it decides the disk, not the result.
SLICES = 4
#: Text bytes hashed at once, list entries joined at once, and rows given out at once.
CHUNK, HELD, ROWS = 2_000_000, 400_000, 20_000
#: Blocks for each element in which linked sets can differ: the more there are, the more long lists are skipped.
SPARE = 1.15
#: In a tag, a level stands above the number of lists to skip.
LEVEL = 32
#: Sets that share less with the hub are sought by their blocks; others by their differences. Those that could be linked to one of the other kind are sought by both.
NEAR = 0.5


def level_bounds(largest: int) -> np.ndarray:
    """Level j has the sizes from bound j to bound j + 1; each bound is at least 1.5 times the one before."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, -(-3 * out[-1] // 2)))
    return np.array([*out, -(-3 * out[-1] // 2)], np.int64)


BOUNDS = level_bounds(1 << 40)


def block_counts(levels: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """Blocks of a set at each level: over the most elements in which linked sets of the level differ, with room for empty blocks."""
    top = BOUNDS[levels + 1] - 1
    enough = SPARE * (2 * top * (t[1] - t[0]) // (t[1] + t[0]) + 1)
    return np.ceil(enough * (1 + 3 * np.exp(-top / enough))).astype(np.int64) + 2


def blocks(sets: list[np.ndarray], t: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list key, number of the set, tag) for all blocks of the sets; a tag has the level and how many lists of that level the set may skip."""
    n = np.array([len(s) for s in sets], np.int64)
    own = np.searchsorted(BOUNDS, n, "right") - 1
    keys, owners, tags = [], [], []
    for up in (0, 1):
        which = np.flatnonzero((n > 0) if up == 0 else (n > 0) & (n * t[1] >= BOUNDS[own + 1] * t[0]))
        if not len(which):
            continue
        levels = own[which] + up
        count = block_counts(levels, t)
        length = n[which]
        flat = np.concatenate([sets[i] for i in which])
        at = np.repeat(np.arange(len(which)), length)
        block = ((flat >> np.uint64(32)) * count[at].astype(np.uint64)) >> np.uint64(32)
        new = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (at[1:] != at[:-1])])
        content = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), new)
        size = np.diff(np.r_[new, len(flat)]).astype(np.uint64)
        place = levels[at[new]].astype(np.uint64) << np.uint64(40)
        keys.append(mix(mix(content + size) ^ (place + block[new])))
        owners.append(which[at[new]])
        # a set with too many empty blocks may have no whole one in common with another such set: these share a list of prefix elements
        filled = np.bincount(at[new], minlength=len(which))
        most = np.minimum(length * t[1] // t[0], BOUNDS[levels + 1] - 1)
        shared = filled - (length + most) * (t[1] - t[0]) // (t[1] + t[0])
        tags.append((levels << LEVEL | np.maximum(shared - 1, 0))[at[new]])
        for i in np.flatnonzero(shared <= 0):
            s = sets[which[i]]
            prefix = s[: len(s) - -(-len(s) * t[0] // t[1]) + 1]
            keys.append(mix(prefix ^ np.uint64(0x2545F4914F6CDD1D)))
            owners.append(np.full(len(prefix), which[i]))
            tags.append(np.full(len(prefix), len(BOUNDS) << LEVEL))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(tags)


def common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def needed(a: int, b: int, t: tuple[int, int]) -> int:
    """Common elements from which sets of sizes a and b are linked: the ceiling of t (a + b) / (1 + t)."""
    return -(-t[0] * (a + b) // (t[0] + t[1]))


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) in parts of about CHUNK bytes."""
    part: list[bytes] = []
    start = size = 0
    for i, x in enumerate(batch.column(column)):
        text = b"" if not x.is_valid else x.as_buffer().to_pybytes()
        if part and size + len(text) > CHUNK:
            yield start, part
            part, start, size = [], i, 0
        part.append(text)
        size += len(text)
    if part:
        yield start, part


FACTS = "kind string, key long, a long, b long, n long"


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def facts_batch(kind: str, key, a, b=None, n=None) -> pa.RecordBatch:  # noqa: ANN001
    size = len(a)
    column = lambda x: pa.nulls(size, pa.int64()) if x is None else x if isinstance(x, pa.Array) else pa.array(x, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([kind] * size, pa.string()), column(key), column(a), column(b), column(n)], names=["kind", "key", "a", "b", "n"])


GATHERED = f"{FACTS}, ids array<long>, tags array<long>"


def gathered(facts: pa.RecordBatch, sizes=None, ids=None, tags=None) -> pa.RecordBatch:  # noqa: ANN001
    """facts with the columns ids and tags: sizes of them for each row, or null."""

    def lists(values) -> pa.Array:  # noqa: ANN001
        if sizes is None:
            return pa.nulls(facts.num_rows, pa.list_(pa.int64()))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values, pa.int64()))

    return pa.RecordBatch.from_arrays([*facts.columns, lists(ids), lists(tags)], names=[*facts.schema.names, "ids", "tags"])


def gather(k: int, t: tuple[int, int]):  # noqa: ANN201
    """For texts: facts N (size n of the set of a row of a), L (a and b have equal sets) and P (n sets are in the list key: a with tag b, and ids with tags).

    What a task can join itself it joins, up to HELD entries at a time: equal sets are one from then on, and a
    list gets one entry with all its sets. So hot lists are pre-aggregated. A row with a null id has N alone.
    """

    def lists(held: list) -> Iterator[pa.RecordBatch]:
        keys, owners, tags = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((owners, keys))
        keys, owners, tags = keys[order], owners[order], tags[order]
        edges = np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)]
        for i in range(0, len(edges) - 1, ROWS):  # batches of bounded size, as the JVM takes each one whole
            part = edges[i : i + ROWS + 1]
            at, rest = part[:-1], np.ones(part[-1] - part[0], bool)
            rest[at - part[0]] = False
            here = slice(part[0], part[-1])
            n = np.diff(part)
            yield gathered(facts_batch("P", as_long(keys[at]), owners[at], tags[at], n), n - 1, owners[here][rest], tags[here][rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, alike = [], 0, {}
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            for start, texts in chunks(batch, 1):
                sets = shingle_sets(texts, k)
                rows = slice(start, start + len(texts))
                yield gathered(facts_batch("N", None, pa.array(ids[rows], mask=~known[rows]), n=np.array([len(s) for s in sets], np.int64)))
                keep, equal = [], []
                for i, s in enumerate(sets):
                    if len(s) and known[start + i]:
                        digest = (len(s), int(mix(s).sum(dtype=np.uint64)), int(mix(s * np.uint64(3)).sum(dtype=np.uint64)))
                        mine = int(ids[start + i])
                        other = alike.setdefault(digest, mine)
                        if other == mine:
                            keep.append(i)
                        else:
                            equal.append((other, mine))
                if equal:
                    pairs = np.array(equal, np.int64)
                    yield gathered(facts_batch("L", None, pairs[:, 0], pairs[:, 1]))
                keys, owners, tags = blocks([sets[i] for i in keep], t)
                if len(keys):
                    held.append((keys, ids[start + np.array(keep, np.int64)[owners]], tags))
                    size += len(keys)
                if size > HELD:
                    yield from lists(held)
                    held, size, alike = [], 0, {}
        if held:
            yield from lists(held)

    return run


def tiles(k: int, t: tuple[int, int]):  # noqa: ANN201
    """Facts L (a and b are linked) of the rows (grp, i, j, part, doc_id, text) in order of tiles (grp, i, j): a tile has two parts of a group, or one.

    Sets already joined in a tile are not compared again.
    """

    def links(i: int, j: int, members: list) -> Iterator[pa.RecordBatch]:
        root = list(range(len(members)))

        def find(x: int) -> int:
            while root[x] != x:
                x = root[x]
            return x

        out = []
        members.sort(key=lambda m: (len(m[2]), m[1]))
        for y in range(1, len(members)):
            b = members[y]
            for x in range(y - 1, -1, -1):
                a = members[x]
                if len(a[2]) * t[1] < len(b[2]) * t[0]:
                    break  # and so for all that are smaller
                if (i == j or a[0] != b[0]) and find(x) != find(y) and common(a[2], b[2]) >= needed(len(a[2]), len(b[2]), t):
                    root[find(y)] = find(x)
                    out.append((a[1], b[1]))
        if out:
            pairs = np.array(out, np.int64)
            yield facts_batch("L", None, pairs[:, 0], pairs[:, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            grp, i, j, part, ids = (batch.column(c).to_pylist() for c in range(5))
            for start, texts in chunks(batch, 5):
                for r, s in enumerate(shingle_sets(texts, k), start):
                    if (here := (grp[r], i[r], j[r])) != at:
                        if held:
                            yield from links(at[1], at[2], held)
                        at, held = here, []
                    if len(s):  # another text of its id may be empty
                        held.append((part[r], ids[r], s))
        if held:
            yield from links(at[1], at[2], held)

    return run


def majority(k: int):  # noqa: ANN201
    """(grp, hub) of rows (grp, text) in order of grp: the elements of more than half of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def hub() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([as_long(values[2 * times > len(held)])], pa.list_(pa.int64()))], names=["grp", "hub"])

        for batch in batches:
            grp = batch.column(0).to_pylist()
            for start, texts in chunks(batch, 1):
                for r, s in enumerate(shingle_sets(texts, k), start):
                    if grp[r] != at:
                        if held:
                            yield hub()
                        at, held = grp[r], []
                    held.append(s)
        if held:
            yield hub()

    return run


def differences(k: int, t: tuple[int, int]):  # noqa: ANN201
    """Facts of the rows (grp, salt, hub, doc_id, text) in order of (grp, salt), the one with the hub first.

    With m elements of the hub missing from a set and p added to it, and weight = t1 m + t0 p for the
    threshold t0 / t1: x and y are linked if (t0 + t1) |Dx & Dy| >= weight x + weight y - (t1 - t0) |hub|.
    Fact Z: a of group b has the weight key, and may be linked without a shared difference; n is the right
    side's last term. Fact D: key is one of a's differences, or of its lists, in the group b. n tells whether
    all sets that can be linked to a share one of such elements with it: 1 yes, 0 not needed; over 1 yes,
    unless the least weight of the group is n - 2 or less, which links a without a comparison.
    """

    def of(grp: int, hub: np.ndarray, x: int, s: np.ndarray, out: dict, far: list) -> None:
        both = common(hub, s)
        weight, room = t[1] * (len(hub) - both) + t[0] * (len(s) - both), (t[1] - t[0]) * len(hub)
        lacks = -(-(weight - room) // (t[0] + t[1]))
        share = both / max(1, len(hub) + len(s) - both)
        if lacks <= 0:
            out["z"].append((x, weight, room))
        if share >= NEAR or lacks <= 0:
            d = np.setxor1d(hub, s, assume_unique=True)
            out["key"].append(d)
            out["a"].append(np.full(len(d), x))
            out["n"].append(np.full(len(d), 2 + room - weight) if lacks <= 0 else (np.arange(len(d)) <= len(d) - lacks).astype(np.int64))
        if share < NEAR + 1 - t[0] / t[1]:
            far.append((x, s))

    def facts(grp: int, out: dict, far: list) -> Iterator[pa.RecordBatch]:
        if far:
            key, owner, _ = blocks([s for _, s in far], t)
            out["key"].append(key)
            out["a"].append(np.array([x for x, _ in far], np.int64)[owner])
            out["n"].append(np.ones(len(key), np.int64))
        if out["z"]:
            z = np.array(out["z"], np.int64)
            yield facts_batch("Z", z[:, 1], z[:, 0], np.full(len(z), grp), z[:, 2])
        if out["key"]:
            key = np.concatenate(out["key"])
            yield facts_batch("D", as_long(key), np.concatenate(out["a"]), np.full(len(key), grp), np.concatenate(out["n"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub, out, far, held = None, None, {}, [], 0
        for batch in batches:
            grp, salt, ids = (batch.column(c).to_pylist() for c in (0, 1, 3))
            for start, texts in chunks(batch, 4):
                for r, s in enumerate(shingle_sets(texts, k), start):
                    if (grp[r], salt[r]) != at or held >= 200:
                        if held:
                            yield from facts(at[0], out, far)
                        at, out, far, held = (grp[r], salt[r]), {"z": [], "key": [], "a": [], "n": []}, [], 0
                    if (h := batch.column(2)[r]).is_valid:
                        hub = np.array(h.values, np.int64).view(np.uint64)
                    else:
                        of(grp[r], hub, ids[r], s, out, far)
                        held += 1
        if held:
            yield from facts(at[0], out, far)

    return run


def compared_whole(docs: DataFrame, groups: DataFrame, k: int, t: tuple[int, int]) -> DataFrame:
    """Links (a, b) of the groups (grp, size, doc_id), by tiles."""
    parts = F.ceil(F.col("size") / SIDE).cast("int")
    mine = groups.select("grp", "doc_id", F.pmod(F.xxhash64("doc_id"), parts).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = mine.select("grp", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "doc_id")
    rows = docs.select("doc_id", "text").join(small_side(dealt), "doc_id").select("grp", "i", "j", "part", "doc_id", "text")
    return rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "doc_id").mapInArrow(tiles(k, t), FACTS).select("a", "b")


def compared_with_hub(docs: DataFrame, groups: DataFrame, k: int, t: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(links, edges) of the large groups (grp, size, doc_id): edges join those that must still be compared."""
    order = Window.partitionBy("grp").orderBy(F.xxhash64("doc_id"), "doc_id")
    asked = groups.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ASKED).select("grp", "doc_id")
    texts = docs.select("doc_id", "text")
    hubs = cut(texts.join(small_side(asked), "doc_id").select("grp", "text").repartition("grp").sortWithinPartitions("grp").mapInArrow(majority(k), "grp long, hub array<long>"))
    salts = F.ceil(F.col("size") / PART).cast("int")
    members = texts.join(small_side(groups.select("grp", F.pmod(F.xxhash64("doc_id"), salts).cast("int").alias("salt"), "doc_id")), "doc_id").select("grp", "salt", F.lit(None).cast("array<long>").alias("hub"), "doc_id", "text")
    copies = groups.select("grp", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")).distinct()
    first = hubs.join(copies, "grp").select("grp", "salt", "hub", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    dealt = members.unionByName(first).repartition("grp", "salt").sortWithinPartitions("grp", "salt", F.col("hub").isNull(), "doc_id")
    found = cut(dealt.mapInArrow(differences(k, t), FACTS))
    weights = found.where("kind = 'Z'").select(F.col("b").alias("grp"), "a", F.col("key").alias("weight"), F.col("n").alias("room"))
    best = small_side(cut(weights.groupBy("grp").agg(F.min(F.struct("weight", "a")).alias("best"))))
    core = weights.join(best, "grp").where("weight + best.weight <= room").select("a", F.col("best.a").alias("b"))
    lists = found.where("kind = 'D'").select(F.col("b").alias("grp"), "key", "a", F.col("n").alias("flag")).join(best, "grp", "left")
    asks = (F.col("flag") == 1) | ((F.col("flag") > 1) & (F.col("best.weight").isNull() | (F.col("flag") - 2 < F.col("best.weight"))))
    lists = cut(lists.select("grp", "key", "a", asks.alias("asks")))
    led = lists.groupBy("grp", "key").agg(F.min(F.when(F.col("asks"), F.col("a"))).alias("lead"), F.min("a").alias("lo"), F.max("a").alias("hi")).where("lead IS NOT NULL AND lo <> hi").select("grp", "key", "lead")
    return core, lists.join(led, ["grp", "key"]).where("lead <> a").select(F.col("lead").alias("a"), F.col("a").alias("b"))


def sized(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    return cut(members.join(sizes, "component").select(F.col("component").alias("grp"), "size", F.col("node").alias("doc_id")))


def shared_lists(lists: DataFrame) -> DataFrame:
    """(a, b) for each list that two sets have and neither skips: a is the smallest id in it, b another.

    lists has (key, a, b, n, ids, tags). Lengths are counted apart, with partial sums, and joined to the entries:
    no task gathers a list. Keys go a slice at a time, and what a slice shuffled is gone before the next one: of its
    entries, only those in lists of more than one are written. A set skips its longest ones.
    """
    none = F.array().cast("array<long>")
    each = F.arrays_zip(F.concat(F.array("a"), F.coalesce("ids", none)).alias("id"), F.concat(F.array("b"), F.coalesce("tags", none)).alias("tag"))
    entries = None
    for s in range(SLICES):
        part = lists.where(F.pmod("key", F.lit(SLICES)) == s)
        long = part.groupBy("key").agg(F.sum("n").alias("long")).where("long > 1")
        of = cut(part.join(long, "key").select("key", "long", F.explode(each).alias("e")).select("key", "long", F.col("e")["id"].alias("a"), F.col("e")["tag"].alias("tag")))
        entries = of if entries is None else entries.unionByName(of)
    place = F.row_number().over(Window.partitionBy("a", "tag").orderBy(F.desc("long"), "key"))
    kept = cut(entries.withColumn("place", place).where(F.col("place") > F.col("tag").bitwiseAND((1 << LEVEL) - 1)).select("key", "a"))
    led = kept.groupBy("key").agg(F.min("a").alias("lead"), F.max("a").alias("last")).where("lead <> last").select("key", "lead")
    return kept.join(led, "key").where("lead <> a").select(F.col("lead").alias("a"), F.col("a").alias("b"))


def jaccard_components(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs.

    Documents are linked if the Jaccard similarity of their sets of distinct k-word shingles is at least the
    threshold, a fraction over 2/3; component_id is the smallest doc_id reachable by links. A text with fewer
    than k words has its whole sequence as one shingle; a null text, or one without words, has none and no
    links. n_shingles is of the row's own text. Rows of one doc_id are one document, which has the links of all
    their texts; so each of them is in its component. A row with a null doc_id is linked with nothing and has a
    null component_id. Shingles are compared by 64-bit hashes. An empty table gives an empty result.
    """
    if not 2 * threshold[1] < 3 * threshold[0] <= 3 * threshold[1]:
        raise ValueError("the threshold is over 2/3 and at most 1")
    ship(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = rows.where("doc_id IS NOT NULL")
    facts = cut(rows.mapInArrow(gather(k, threshold), GATHERED))
    edges = shared_lists(facts.where("kind = 'P'").select("key", "a", "b", "n", "ids", "tags"))
    links = facts.where("kind = 'L'").select("a", "b")
    groups = sized(components(edges))
    if not groups.isEmpty():
        links = links.unionByName(compared_whole(known, groups.where(F.col("size") <= WHOLE), k, threshold))
        large = groups.where(F.col("size") > WHOLE)
        if not large.isEmpty():
            core, edges = compared_with_hub(known, large, k, threshold)
            links = links.unionByName(core).unionByName(compared_whole(known, sized(components(edges)), k, threshold))
    classes = components(links)
    sizes = facts.where("kind = 'N'").select(F.col("a").alias("doc_id"), F.col("n").alias("n_shingles"))
    return sizes.join(small_side(classes.withColumnRenamed("node", "doc_id")), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """docs without those that have a smaller doc_id in their component; all columns are kept, whatever their names.

    Of rows that are equal in every column, one stays; rows of one doc_id that differ are one document and stay
    or go together. Rows with a null doc_id stay. An empty table gives an empty result.
    """
    classes = jaccard_components(docs, k, threshold).where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = small_side(cut(classes))
    stay = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    again = cut(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id")))
    if again.isEmpty():
        return stay
    again = small_side(again)
    twice = stay["doc_id"] == again["again_id"]
    return stay.join(again, twice, "left_anti").unionByName(stay.join(again, twice, "left_semi").dropDuplicates())
