"""Vectorised 64-bit hashes of words, shingles and byte windows, alike in every process."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
POWERS: dict[str, np.ndarray] = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    key = str(base)
    if key not in POWERS or len(POWERS[key]) < n:
        x = np.full(max(n, 1 << 16), base, np.uint64)
        x[0] = 1
        POWERS[key] = np.multiply.accumulate(x)
    return POWERS[key][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every bit depends on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span of data."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), BASE), out=total[1:])
    raw = (total[ends] - total[starts]) * powers(len(data) + 1, INVERSE)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """For each text, its distinct k-word shingles as sorted hashes; with fewer words, one for all of them; with none, none.

    A-Z count as a-z; words are runs without ASCII white space.
    """
    data = np.frombuffer(b"\n".join(texts).translate(LOWER), np.uint8)
    word = np.concatenate(([False], ~WHITE[data], [False]))
    turns = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = turns[::2], turns[1::2]
    words = spans(data, starts, ends)
    first = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    rows = max(0, len(words) - k + 1)
    shingles = words[k - 1 : k - 1 + rows]
    for i in range(k - 2, -1, -1):
        shingles = mix(shingles * np.uint64(0xA24BAED4963EE407) + words[i : i + rows])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(shingles[a : b - k + 1]))
        elif b > a:
            x = np.array([b - a], np.uint64)
            for i in range(a, b):
                x = mix(x * np.uint64(31) + words[i : i + 1])
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
