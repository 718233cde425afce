"""Exact top-k search by inner product, with multi-resolution segment statistics on rotated axes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import cut, ship

#: Shares of the axes, from the one with the most energy on, that a level has singly; the others are in segments of SEGMENT.
LEVELS, SEGMENT = (0.25, 0.5, 0.75), 16
#: Rows of a packed block of vectors, and values in it at most.
ROWS, VALUES = 2_000, 1_000_000
#: Copies of the queries' blocks: rows are dealt to so many groups, each of which meets its own copies.
GROUPS = 64
#: Queries and rows bounded at once, best answers held by a task, and the share of surviving pairs up to which each pair is computed alone.
TILE, HELD, FEW = 1_000, 4_000_000, 0.05


class Axes:
    """An orthogonal rotation and the levels of statistics in it.

    The axes are the principal ones of the block of queries: any rotation keeps inner products, and this one
    brings most of them onto few axes. A level has the leading axes as they are, and of each segment of the
    others the mean and the deviation (the norm about the mean), both scaled so that the dot product of two
    vectors' statistics is at least that of the vectors.
    """

    def __init__(self, queries: np.ndarray) -> None:
        d = queries.shape[1]
        energy, axes = np.linalg.eigh(queries.T @ queries)
        self.axes = axes[:, ::-1]
        self.heads = sorted({round(d * share) for share in LEVELS})

    def statistics(self, x: np.ndarray) -> list[np.ndarray]:
        """For each level, the statistics of the rows of x, from coarse to fine."""
        turned = x @ self.axes
        out = []
        for head in self.heads:
            tail = turned[:, head:]
            parts = np.pad(tail, ((0, 0), (0, -tail.shape[1] % SEGMENT))).reshape(len(x), -1, SEGMENT)
            mean = parts.mean(2)
            out.append(np.hstack([turned[:, :head], mean * np.sqrt(SEGMENT), np.sqrt(((parts - mean[:, :, None]) ** 2).sum(2))]))
        return out


def wide(x: np.ndarray, d: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, d - x.shape[1]))) if x.shape[1] < d else x


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    d = int(n.max(initial=0))
    if (n == d).all():
        return flat.reshape(len(n), d)
    out = np.zeros((len(n), d), np.int64)
    out[np.arange(d) < n[:, None]] = flat
    return out


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row; whole numbers in float64 while every sum is exact, else Python's integers."""
    if max(1, x.shape[1]) * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) < 2**53:
        return np.einsum("ij,ij->i", q.astype(np.float64), x.astype(np.float64)).astype(np.int64)
    return np.array([int(v) for v in (q.astype(object) * x.astype(object)).sum(1)], np.int64)


class Best:
    """The k best (score, smaller id first) of each query of a block so far."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.axes = Axes(queries.astype(np.float64))
        self.levels = self.axes.statistics(queries.astype(np.float64))
        self.floor = np.full(len(query_ids), -np.inf)
        self.q = self.id = self.score = np.zeros(0, np.int64)

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        q, ids, score = (np.concatenate(x) for x in ((self.q, q), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        first = np.r_[True, q[1:] != q[:-1]]
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        full = rank == self.k - 1
        self.floor[q[full]] = score[full]
        keep = rank < self.k
        self.q, self.id, self.score = q[keep], ids[keep], score[keep]

    def scan(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Adds the rows x, those of large norm first, so that the k-th scores rise early."""
        if x.shape[1] > self.queries.shape[1]:
            known = self.q, self.id, self.score
            self.__init__(self.query_ids, wide(self.queries, x.shape[1]), self.k)
            self.add(*known)
        floats = wide(x, self.queries.shape[1]).astype(np.float64)
        order = np.argsort(-np.einsum("ij,ij->i", floats, floats), kind="stable")
        ids, x, floats = ids[order], wide(x, self.queries.shape[1])[order], floats[order]
        levels = self.axes.statistics(floats)
        step = max(4 * self.k, 64)  # a small first tile, from which each query has its k rows
        for a, b in zip([0, *range(step, len(ids), TILE)], [*range(step, len(ids), TILE), len(ids)], strict=True):
            for c in range(0, len(self.query_ids), TILE):
                self.tile(slice(c, c + TILE), ids[a:b], x[a:b], [level[a:b] for level in levels])

    def tile(self, at: slice, ids: np.ndarray, x: np.ndarray, levels: list[np.ndarray]) -> None:
        """Pairs whose upper bound is under the query's k-th score fall, level by level; the others are computed exactly."""
        rows, cols = np.arange(len(self.query_ids))[at], np.arange(len(ids))
        for mine, other in zip(self.levels, levels, strict=True):
            bound = mine[rows] @ other[cols].T
            alive = bound + 1e-9 * (1 + np.abs(bound)) >= self.floor[rows, None]
            keep = alive.any(1)
            rows, alive = rows[keep], alive[keep]
            keep = alive.any(0)
            cols, alive = cols[keep], alive[:, keep]
            if not len(rows) or alive.mean() < FEW:
                break
        q, c = np.nonzero(alive)
        q, c = rows[q], cols[c]
        for i in range(0, len(q), 100_000):  # pairs computed at once
            qi, ci = q[i : i + 100_000], c[i : i + 100_000]
            score = exact_scores(self.queries[qi], x[ci])
            good = (score >= self.floor[qi]) & (self.query_ids[qi] != ids[ci])
            self.add(qi[good], ids[ci[good]], score[good])


def usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


PACKED = "ids array<long>, width int, vectors array<long>"


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, v) as blocks: the ids, and the vectors one after the other, filled with zeros to one width."""
    for whole in batches:
        at = 0
        while at < whole.num_rows:
            batch = whole.slice(at, ROWS)
            n = np.maximum.accumulate(np.diff(batch.column(1).offsets.to_numpy())) * np.arange(1, batch.num_rows + 1)
            batch = batch.slice(0, max(1, int((n <= VALUES).sum())))
            at += batch.num_rows
            x = matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy()]), pa.array([x.shape[1]], pa.int32()), pa.array([x.ravel()])], names=["ids", "width", "vectors"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of vectors for which is_query holds, the k other rows with the largest inner products.

    Components x count as floor(scale * x). Ties go to the smaller vec_id; with fewer candidates, all are
    given. Rows with a null vec_id, a null vector or a null or non-finite component take no part; missing
    components of shorter vectors are zeros. Of several queries with one vec_id, the one with the smallest
    vector counts; a query's own row is every row with its vec_id; other repeated rows each count. An empty
    table gives an empty result.

    Rows and queries are packed into blocks of bounded size. Each block of rows meets each block of queries
    once: queries' blocks are copied for GROUPS groups and joined by the group, so that nothing passes through
    the driver's Python, and Spark broadcasts the queries only if they are under its own threshold. Tasks keep
    k rows a query for HELD answers at most before they give them out. The number of pairs is that of queries
    times rows, as the answer must be exact; the bounds spare most of the exact products.
    """
    ship(vectors)
    rows = cut(
        vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
            F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"), is_query.alias("asked")
        )
    )
    asked = rows.where("asked").groupBy("vec_id").agg(F.min("v").alias("v"))
    values = asked.agg(F.sum(F.size("v"))).first()[0] or 0
    blocks = asked.repartition(max(1, -(-values // VALUES))).mapInArrow(pack, PACKED)
    copies = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("part"), F.col("ids").alias("q_ids"), F.col("width").alias("q_width"), F.col("vectors").alias("q_vectors"))
    packed = rows.select("vec_id", "v").mapInArrow(pack, PACKED).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(GROUPS)).cast("int"))
    met = packed.join(copies, "part").select("ids", "width", "vectors", "q_ids", "q_width", "q_vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], Best] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for best in held.values():
                yield pa.RecordBatch.from_arrays([pa.array(best.query_ids[best.q]), pa.array(best.id), pa.array(best.score)], names=["query_id", "vec_id", "score"])
            held.clear()

        def block(batch: pa.RecordBatch, i: int, at: int) -> tuple[np.ndarray, np.ndarray]:
            ids = batch.column(at)[i].values.to_numpy()
            return ids, batch.column(at + 2)[i].values.to_numpy().reshape(len(ids), batch.column(at + 1)[i].as_py())

        for batch in batches:
            for i in range(batch.num_rows):
                query_ids, queries = block(batch, i, 3)
                key = (len(query_ids), int(query_ids[0]))
                if key not in held:
                    if sum(b.queries.size + b.k * len(b.query_ids) for b in held.values()) > HELD:
                        yield from given()
                    held[key] = Best(query_ids, queries, k)
                held[key].scan(*block(batch, i, 0))
        yield from given()

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
