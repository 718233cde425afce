"""Suffix arrays and common prefixes against plain sorting."""

import random

import numpy as np
import pytest

from citeloom.llm import suffixes


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefgh\x00\xff"])
def test_arrays(letters):
    r = random.Random(len(letters))
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(1, 90))).encode("latin-1") for _ in range(60)] + [b"abab" * 30] * 3
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    number = np.repeat(np.arange(len(texts)), sizes)
    order, rank = suffixes.suffix_array(data, (base + sizes)[number], number)
    want = sorted(range(len(data)), key=lambda i: (bytes(data[i : base[number[i]] + sizes[number[i]]]), number[i]))
    assert order.tolist() == want and (rank[order] == np.arange(len(data))).all()
    prefixes = suffixes.common_prefixes(data, base, sizes, order, rank)[order]
    suffix = [bytes(data[i : base[number[i]] + sizes[number[i]]]) for i in want]
    assert prefixes[0] == 0
    for a, b, n in zip(suffix[:-1], suffix[1:], prefixes[1:], strict=True):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        assert k == n


def test_long_runs_are_parted():
    text = b"x" * 1000
    _, first, count, _ = suffixes.runs([text])
    assert count.max() <= suffixes.LONGEST and first.tolist() == list(range(0, 951, suffixes.LONGEST)) and count.sum() == 951


def test_windows_of_like_size_are_merged():
    r = np.random.default_rng(2)
    before, known = [], {}
    for _ in range(9):
        rows = np.unique(r.integers(0, 4, (50, 7)).astype(np.uint64), axis=0)
        docs = r.integers(0, 1000, len(rows))
        for row, d in zip(map(tuple, rows.tolist()), docs.tolist(), strict=True):
            known[row] = min(d, known.get(row, d))
        before.append((rows, docs))
        suffixes.merged_windows(before)
    got = {}
    for rows, docs in before:
        assert rows.tolist() == sorted(rows.tolist())
        for row, d in zip(map(tuple, rows.tolist()), docs.tolist(), strict=True):
            got[row] = min(d, got.get(row, d))
    assert got == known and len(before) < 6
