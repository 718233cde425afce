"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, and decoding by offsets.

The rule that parts a text before its merges (contractions; letters, digits or other signs with a space before
them; white space but its last character before a word) is a small automaton over classes of code points. Each
class maps states to states, and such maps compose associatively: blocks are scanned side by side, the maps of
whole blocks are composed, and with its true first state each block is scanned once more. Where slices start is
then told by neighbouring states, without a regular expression over the text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import ship
from citeloom.llm.sentencepieces import part_sizes

#: Slices of a generation of those whose ids are remembered, and the longest of them in bytes.
CACHED, LONGEST = 100_000, 128
#: The rank of no pair.
NEVER = 1 << 40
#: Code points of a long text that are parted at once, and those of a block of the scan.
WINDOW, BLOCK = 1_000_000, 64

#: Classes of code points. The last six are letters; those of contractions have classes of their own.
END, NUMBER, OTHER, WHITE, SPACE, APOSTROPHE, LETTER, S_T_M_D, R, V, L, E = range(12)
#: States: what the last character belongs to. AP: an apostrophe that starts a slice; AP_R, AP_V, AP_L: and the letter after it; DONE: a contraction's last letter.
START, LETTERS, NUMBERS, OTHERS, BLANK, WHITES, AP, AP_R, AP_V, AP_L, DONE = range(11)


def transitions() -> np.ndarray:
    """The state after each class and state."""
    t = np.empty((12, 11), np.uint8)
    for c, s in ((END, START), (NUMBER, NUMBERS), (OTHER, OTHERS), (WHITE, WHITES), (SPACE, BLANK)):
        t[c] = s
    t[APOSTROPHE] = AP
    t[APOSTROPHE, [OTHERS, BLANK, AP]] = OTHERS
    t[LETTER:] = LETTERS
    t[S_T_M_D, AP] = DONE
    t[[R, V, L], AP] = [AP_R, AP_V, AP_L]
    t[L, AP_L] = DONE
    t[E, [AP_R, AP_V]] = DONE
    return t


TRANSITIONS = transitions()
#: Classes after which the state does not depend on the one before.
CONSTANT = (TRANSITIONS == TRANSITIONS[:, :1]).all(axis=1)


@cache
def class_table() -> bytes:
    """The class of every code point. What is a letter, a number or white space is asked of the tokenizer library itself, whose tables decide."""
    import tiktoken

    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))).astype("<u4")
    every = points.tobytes().decode("utf-32-le")
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        got = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)).decode()
        table[np.frombuffer(got.encode("utf-32-le"), "<u4")] = kind
    table[ord(" ")], table[ord("'")] = SPACE, APOSTROPHE
    for letters, kind in (("stmd", S_T_M_D), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in letters]] = kind
    return table.tobytes()


def scan(classes: np.ndarray) -> np.ndarray:
    """The state after each character, from START."""
    n = len(classes)
    blocks = np.full(-(-n // BLOCK) * BLOCK, END, np.uint8)
    blocks[:n] = classes
    blocks = np.ascontiguousarray(blocks.reshape(-1, BLOCK).T)
    flat, width = TRANSITIONS.ravel(), TRANSITIONS.shape[1]
    at = blocks.astype(np.int16) * width
    # the map of a block: one state if any of its classes is constant, else a state for each first one
    last = np.zeros(blocks.shape[1], np.uint8)
    for row in at:
        last = flat[row + last]
    first = np.zeros_like(last)
    first[1:] = last[:-1]
    open_ = np.flatnonzero(~CONSTANT[blocks].any(axis=0))
    maps = np.repeat(np.arange(width, dtype=np.uint8)[:, None], len(open_), axis=1)
    for row in at[:, open_]:
        maps = flat[row + maps]
    for k, b in enumerate(open_[open_ + 1 < len(first)].tolist()):
        first[b + 1] = maps[first[b], k]
    states = np.empty(blocks.shape, np.uint8)
    now = first
    for i, row in enumerate(at):
        now = flat[row + now]
        states[i] = now
    return states.T.ravel()[:n]


def slice_starts(classes: np.ndarray) -> np.ndarray:
    """Whether a slice starts at each character; texts are parted by END."""
    now = scan(classes)
    before, after = np.zeros_like(now), np.zeros_like(now)
    before[1:], after[:-1] = now[:-1], now[1:]
    ended = np.ones(len(now), bool)
    ended[:-1] = classes[1:] == END
    held = np.isin(before, (AP_R, AP_V, AP_L))
    starts = (now == LETTERS) & ~((before == LETTERS) | (before == BLANK) | held)
    starts |= ((now == AP_R) | (now == AP_V) | (now == AP_L)) & (after != DONE)
    starts |= (now == NUMBERS) & (before != NUMBERS) & (before != BLANK)
    starts |= (now == OTHERS) & (before != OTHERS) & (before != BLANK) & (before != AP)
    starts |= now == AP
    white = (now == BLANK) | (now == WHITES)
    starts |= white & ~((before == BLANK) | (before == WHITES))
    starts |= white & ~((after == BLANK) | (after == WHITES)) & ~ended
    return starts & (classes != END)


def merged(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of a slice: of all neighbouring parts, those whose joint bytes rank first are joined, the leftmost of equals, until no joint bytes have a rank."""
    if (whole := ranks.get(piece)) is not None:
        return (whole,)
    if len(piece) > LONGEST:
        return merged_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2], NEVER) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) != NEVER:
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
    return tuple([ranks[x] for x in parts])


def merged_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same with a heap of pairs, in n log n steps."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts at i
    back = list(range(-1, n - 1))  # the start of the part before it
    gone = bytearray(n)
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i] or end[i] >= n or end[end[i]] != stop:
            continue
        gone[end[i]] = 1
        end[i] = stop
        if stop < n:
            back[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if i and (r := ranks.get(piece[back[i] : stop])) is not None:
            heapq.heappush(heap, (r, back[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(out)


class Slices(dict):
    """The ids of slices met before, in two generations: a full one is kept until the next one is full, and what is met again moves on."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks, self.old = ranks, {}

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        ids = self.old.get(piece) or merged(piece, self.ranks)
        if len(piece) <= LONGEST:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Vocabulary:
    """Ranks, the bytes of each id end to end, and the classes of code points."""

    def __init__(self, ranks: bytes, classes: bytes) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.classes = np.frombuffer(classes, np.uint8)
        self.slices = Slices(self.ranks)
        known = sorted(self.ranks.items(), key=lambda x: x[1])
        self.size = known[-1][1] + 1
        self.lengths = np.zeros(self.size, np.int64)
        self.lengths[[i for _, i in known]] = [len(b) for b, _ in known]
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(b for b, _ in known), np.uint8)

    def encoded(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of each one's; a text of its own may be of any length."""
        whole = [t.decode("utf-8", "replace") for t in texts]
        if len(whole) == 1 and len(whole[0]) > WINDOW:
            ids = np.concatenate(list(self.windows(whole[0])))
            return ids, np.array([len(ids)])
        joint, ends = "".join(whole), np.cumsum([len(t) for t in whole])
        points = np.frombuffer(joint.encode("utf-32-le"), "<u4")
        starts = slice_starts(np.insert(self.classes[points], ends, END))
        return self.ids(joint, points, np.delete(starts, ends + np.arange(len(ends))), ends)

    def windows(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a long text: what follows the start of a slice does not depend on what is before it, so a window ends at the last start whose neighbours it has."""
        at, width = 0, WINDOW
        while at < len(text):
            part = text[at : at + width]
            points = np.frombuffer(part.encode("utf-32-le"), "<u4")
            starts = slice_starts(self.classes[points])
            if at + width < len(text):
                stop = np.flatnonzero(starts[:-4])[-1]
                if stop == 0:  # one slice is longer than the window
                    width *= 2
                    continue
                part, points, starts = part[:stop], points[:stop], starts[:stop]
            yield self.ids(part, points, starts, np.array([len(part)]))[0]
            at, width = at + len(part), WINDOW

    def ids(self, text: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices of joint texts, and how many belong to each. starts: for each code point, whether a slice starts there; ends: where each text stops."""
        data, n = text.encode(), 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        first = np.flatnonzero(starts)
        at = np.append((np.cumsum(n) - n)[first], len(data)).tolist()
        found = [self.slices[data[a:b]] for a, b in zip(at, at[1:], strict=False)]
        each = np.concatenate(([0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))))
        upto = each[np.searchsorted(first, ends)]
        return np.fromiter(chain.from_iterable(found), np.int32, each[-1]), np.diff(upto, prepend=0)

    def decoded(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bytes of ids, each put at its place; the places have no gaps."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError(f"ids are 0 to {self.size - 1}")
        n = self.lengths[ids]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out = np.empty(int(n.sum()), np.uint8)
        out[np.repeat(at, n) + within] = self.bytes[np.repeat(self.places[ids], n) + within]
        return out


LOADED: dict[int, Vocabulary] = {}


def loaded(shared: tuple[bytes, bytes]) -> Vocabulary:
    """Once for a worker process."""
    key = hash(shared)
    if key not in LOADED:
        LOADED.clear()
        LOADED[key] = Vocabulary(*shared)
    return LOADED[key]


def vocabulary(df: DataFrame, ranks: str):
    """The rank file and the class table for all tasks: two megabytes, whatever the data."""
    ship(df)
    with open(ranks, "rb") as f:
        return df.sparkSession.sparkContext.broadcast((f.read(), class_table()))


def encode(docs: DataFrame, ranks: str, back: bool = False) -> DataFrame:
    """(doc_id, ids, offsets, n_tokens) for each row of docs, and with back the bytes decoded from ids and offsets; ranks: path of a rank file that the driver can read.

    ids are those of the whole text without special tokens, offsets the byte at which each id's bytes start in
    the text. A null or empty text has empty lists. Rows stand alone, so repeated rows and null ids are
    answered like others, no table is too small, and further columns are left out. No shuffle; texts are
    encoded about two megabytes at once, a longer one by windows, with a bounded memory of slices.
    """
    shared = vocabulary(docs, ranks)
    names = ["doc_id", "ids", "offsets", "n_tokens", *["bytes"] * back]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(shared.value)
        for whole in batches:
            row = 0
            for n in part_sizes(whole.column(1)):
                batch = whole.slice(row, n)
                row += n
                ids, count = v.encoded([t or b"" for t in batch.column(1).to_pylist()])
                ends = np.concatenate(([0], np.cumsum(count)))
                place = np.concatenate(([0], np.cumsum(v.lengths[ids])))
                offsets = place[:-1] - np.repeat(place[ends[:-1]], count)
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (ids, offsets)]
                more = [whole_bytes(v, ids, offsets, count)] if back else []
                yield pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(count, pa.int64()), *more], names=names)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>, n_tokens long" + ", bytes binary" * back)


def whole_bytes(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray, count: np.ndarray, none: np.ndarray | None = None) -> pa.Array:
    """The bytes of each row, of which count has the number of ids; none: rows that have null."""
    ends = np.concatenate(([0], np.cumsum(count)))
    size = np.concatenate(([0], np.cumsum(v.lengths[ids])))[ends]  # where each row's bytes start
    first = np.zeros(len(count), np.int64)
    first[count > 0] = offsets[ends[:-1][count > 0]]
    data = v.decoded(ids, offsets + np.repeat(size[:-1] - first, count))
    mask = pa.array(~none).buffers()[1] if none is not None and none.any() else None
    return pa.Array.from_buffers(pa.large_binary(), len(count), [mask, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def decode(rows: DataFrame, ranks: str, keep: Sequence[str] = ()) -> DataFrame:
    """(bytes, keep...) of (ids, offsets): each id's bytes are put at its offset, so that any slice of both lists, too, gives its part of the text.

    Null lists give null bytes; ids outside the vocabulary are an error.
    """
    shared = vocabulary(rows, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(shared.value)
        for batch in batches:
            ids, offsets, none = batch.column(0), batch.column(1), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            count = np.diff(ids.offsets.to_numpy())
            count[none] = 0
            out = whole_bytes(v, ids.flatten().to_numpy(), offsets.flatten().to_numpy().astype(np.int64), count, none)
            yield pa.RecordBatch.from_arrays([out, *batch.columns[2:]], names=["bytes", *keep])

    kinds = dict(rows.dtypes)
    return rows.select("ids", "offsets", *keep).mapInArrow(run, ", ".join(["bytes binary", *(f"{c} {kinds[c]}" for c in keep)]))
