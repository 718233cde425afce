"""Blocks, tiles and levels give what all pairs give, for vectors with and without structure."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm import topk


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_blocks(monkeypatch, spread):
    monkeypatch.setattr(topk, "TILE", 37)
    r = np.random.default_rng(3)
    x = np.floor(200 * r.normal(size=(900, 24)) * np.exp(-spread * np.arange(24) / 4)).astype(np.int64)
    x[50:80] = x[0]  # ties
    ids = np.arange(900)
    asked = ids % 10 == 0
    best = topk.Best(ids[asked], x[asked], 5)
    for a in range(0, 900, 250):
        best.scan(ids[a : a + 250], x[a : a + 250])
    got = {}
    for q, i, s in zip(best.q, best.id, best.score, strict=True):
        got.setdefault(int(best.query_ids[q]), []).append((-int(s), int(i)))
    for q in ids[asked]:
        scores = x @ x[q]
        assert got[q] == sorted((-int(scores[i]), int(i)) for i in ids if i != q)[:5]


def test_bounds_hold():
    r = np.random.default_rng(5)
    for d in (1, 3, 20, 64):
        q, x = r.normal(size=(40, d)), r.normal(size=(90, d))
        axes = topk.Axes(q)
        for a, b in zip(axes.statistics(q), axes.statistics(x), strict=True):
            assert (a @ b.T >= q @ x.T - 1e-9).all()


def test_packed_rows_are_bounded(monkeypatch):
    monkeypatch.setattr(topk, "VALUES", 40)
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array([[1] * (i % 7 + 1) for i in range(20)])], names=["vec_id", "v"])
    out = list(topk.pack(iter([batch])))
    assert [i for b in out for i in b.column(0)[0].as_py()] == list(range(20)) and all(len(b.column(2)[0]) <= 40 for b in out)


def test_repeated_ids_and_hot_vector(spark):
    rows = [(0, [1.0, 2.0]), (0, [3.0, -1.0]), (None, [9.0, 9.0]), (50, [])] + [(i, [1.0, 1.0]) for i in range(1, 40)]
    df = spark.createDataFrame([(*x, "c") for x in rows], "vec_id long, embedding array<double>, part string").repartition(5)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert got[:5] == [(0, n, n, 3 * 256 * 256) for n in range(1, 6)]
    assert [x[2:] for x in got[5:]] == [(0, 0), (0, 0), (1, 0), (2, 0), (3, 0)]
