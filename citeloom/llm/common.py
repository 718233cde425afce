"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.sources.tables import cut

#: White space of the contracts: space and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"

#: A join side of up to so many narrow rows of fixed width (about 8 MB) is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once for a row, however often body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A join side of rows of a fixed width, with a broadcast hint if it was counted to be small enough; otherwise the join shuffles it."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


SHIPPED: set[str] = set()


def ship(df: DataFrame) -> None:
    """Gives this package to the session's Python workers, once: Spark hands the file to every executor."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in SHIPPED:
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="citeloom")) / "citeloom_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted((root / "citeloom").rglob("*.py")):
                z.write(f, f.relative_to(root))
        sc.addPyFile(str(target))
        SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Edges that a task contracts at once.
EDGES = 500_000


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of edges (u, v), for up to EDGES at a time: (node, smallest node reachable by them), and (node, node) for a node alone.

    So what a task can join itself travels as one edge a node at most, and components stay as they are.
    """

    def joined(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
        a, b = at[: len(u)], at[len(u) :]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            while (further := root[root]).tobytes() != root.tobytes():
                root = further
            if (root[a] == root[b]).all():
                break
        keep = (root != np.arange(len(nodes))) | (np.bincount(root, minlength=len(nodes)) == 1)
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[root[keep]])], names=["u", "v"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= EDGES:
            yield joined(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield joined(*(np.concatenate(x) for x in zip(*held, strict=True)))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of the edges (whole numbers): component is the smallest node reachable.

    Edges meet by their larger end, and tasks first contract what they hold. Then, in a round, each node takes
    the smallest of its neighbours and itself, and then what that one took; edges are drawn between what their
    ends took, without loops and repetitions, until none is left. So edges get fewer with every round, hot
    nodes pre-aggregate by min, and each round's tables are written, so that no plan grows with the rounds.
    Null ends are no nodes; loops give a component of their own node.
    """
    ends = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    ends = ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    ends = cut(ends.repartition("u").mapInArrow(forest, "u long, v long").distinct())
    placed = None
    while placed is None or not ends.isEmpty():
        both = ends.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")), F.struct(F.col("v").alias("x"), F.col("u").alias("y")))).alias("e")).select("e.*")
        took = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("y"))
        ahead = took.select(F.col("x").alias("y"), F.col("y").alias("z"))
        took = cut(took.join(ahead, "y").select("x", F.least("y", "z").alias("to")))
        if placed is None:
            placed = took.select(F.col("x").alias("node"), F.col("to").alias("component"))
        else:
            placed = cut(placed.join(took.withColumnRenamed("x", "component"), "component", "left").select("node", F.coalesce("to", "component").alias("component")))
        drawn = ends.join(took.select(F.col("x").alias("u"), F.col("to").alias("p")), "u").join(took.select(F.col("x").alias("v"), F.col("to").alias("q")), "v")
        ends = cut(drawn.where("p <> q").select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v")).distinct())
    return placed
