"""Every source, named or not, keeps to its share at every prefix of the mix."""

from collections import Counter

import pytest

from citeloom.llm import mixing


def check_shares(rows, weights, rest):
    blocks = {}
    for r in rows:
        blocks.setdefault(r.slot, set()).add((r.source, r.block))
    assert all(len(b) == 1 for b in blocks.values()) and sorted(blocks) == list(range(len(blocks)))
    order = [next(iter(blocks[t]))[0] for t in range(len(blocks))]
    left, given, since = Counter(order), Counter(), 0
    live = {k: weights.get(k, rest) for k in left}
    for t, source in enumerate(order):
        given[source] += 1
        left[source] -= 1
        for k, w in live.items():
            assert abs(given[k] - w * (t + 1 - since) / sum(live.values())) < 1
        if not left[source]:  # used up: the others go on by their own weights
            live.pop(source)
            given, since = Counter(), t + 1
    assert not live


@pytest.mark.parametrize("sizes", [{f"src{i}": 40 for i in range(20)}, {"src0": 90, "src1": 7, "src9": 300, "other": 25, None: 33}])
def test_each_source_keeps_to_its_share(spark, sizes):
    weights = {"src0": 5, "src1": 3, "src2": 3, "src3": 2, "src4": 2}
    docs = spark.createDataFrame([(f"{k}-{i}", k) for k, n in sizes.items() for i in range(n)], "doc_id string, source string")
    rows = mixing.placed(docs, weights, block_rows=2).collect()
    assert sorted(r.position for r in rows) == list(range(sum(sizes.values())))
    check_shares(rows, weights, 1)


def test_sources_have_a_bound(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_LANES", 3)
    with pytest.raises(ValueError, match="sources"):
        mixing.placed(spark.createDataFrame([(i, str(i)) for i in range(3)], "doc_id long, source string"), {"a": 1})
