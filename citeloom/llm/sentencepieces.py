"""SentencePiece encoding and decoding by a streaming Viterbi over the pieces of a BPE model.

A BPE model's scores are merge ranks: adding them up over a path does not give the model's segmentation. What
does is that two pieces may stand side by side only if the merges leave just these two of their joint text,
and that of all pieces that can end a prefix, exactly one stands after the prefix before it in that way. So
each place has one survivor, found from the places at most the longest piece back, and ids are those that
SentencePiece gives itself. Whole texts go through, character by character, and nothing parts them before: pieces
are given out up to where the paths that are still live converge. As windows recur, the steps between them are
remembered, so that Python sees each different step once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain, islice
from operator import attrgetter, getitem

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from citeloom.llm.common import ship

SPACE = "▁"
#: Behind a text in the stream, and its code.
END, ENDED = "", -1
#: Entries of the cache of pairs, and steps between windows that are remembered; what is full starts anew, so that memory is bounded.
CACHED, STEPS = 300_000, 1_000_000
#: Text bytes encoded at once, and characters of the stream fed at once.
CHUNK, STRETCH = 2_000_000, 500_000
NEVER = float("inf")
CODE = attrgetter("code")


class Pieces:
    """A model's pieces; proto: the bytes of its file."""

    def __init__(self, proto: bytes) -> None:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = p.get_piece_size()
        texts = [p.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (p.is_unknown(i) or p.is_control(i) or p.is_byte(i) or p.is_unused(i))]
        self.ids = {texts[i]: i for i in plain}
        self.ranks = {texts[i]: -p.get_score(i) for i in plain}
        #: Nodes by their next character; a piece that ends at a node stands there at 0.
        self.trie: dict = {}
        for t in self.ids:
            node = self.trie
            for c in t:
                node = node.setdefault(c, {})
            node[0] = t
        self.byte_ids = {int(texts[i][3:5], 16): i for i in range(n) if p.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.unknown = p.unk_id()
        #: What an id gives alone: nothing if it is a control id, a character if it is a byte of ASCII.
        self.texts = ["" if p.is_control(i) else " ⁇ " if p.is_unknown(i) else chr(self.bytes_of[i]) if i in self.bytes_of else t.replace(SPACE, " ") for i, t in enumerate(texts)]
        self.high = {i for i, b in self.bytes_of.items() if b >= 128}
        #: Whether the model puts a space before a text.
        self.prefix = SPACE if p.encode("a", out_type=str)[0].startswith(SPACE) else ""
        #: Characters of each code: an id's piece, from len(texts) on a character that is no piece, at -1 the end of a text.
        self.sizes = np.array([*map(len, texts), 1, 0], np.int32)
        #: Pairs of characters inside of pieces: over others nothing merges.
        self.inner = {t[k : k + 2] for t in self.ids for k in range(len(t) - 1)}
        self.windows: dict[tuple, Window] = {}
        self.steps = 0
        self.pairs: dict[tuple[str, str], bool] = {}
        self.edges: dict[str, tuple[list, list]] = {}

    def grown(self, piece: str) -> tuple[list, list]:
        """How the left and the right edge of a piece grow by its merges: the parts there, each with the rank that its merges wait for."""
        if piece not in self.edges:
            parts = [(c, -NEVER) for c in piece]
            left, right = [parts[0]], [parts[-1]]
            while len(parts) > 1:
                rank, i = min((self.ranks.get(parts[i][0] + parts[i + 1][0], NEVER), i) for i in range(len(parts) - 1))
                if rank == NEVER:
                    break
                parts[i : i + 2] = [(parts[i][0] + parts[i + 1][0], max(rank, parts[i][1], parts[i + 1][1]))]
                if i == 0:
                    left.append(parts[0])
                if i == len(parts) - 1:
                    right.append(parts[-1])
            self.edges[piece] = (left, right)
        return self.edges[piece]

    def beside(self, a: str, b: str) -> bool:
        """Whether the merges of the text a + b leave just a and b: nothing merges across before the edges have grown.

        Of merges of one rank, the leftmost goes first: one in a, then one across, then one in b.
        """
        known = self.pairs.get((a, b))
        if known is None:
            right, left = self.grown(a)[1], self.grown(b)[0]
            i = j = 0
            while True:
                across = self.ranks.get(right[i][0] + left[j][0], NEVER)
                in_a = right[i + 1][1] if i + 1 < len(right) else NEVER
                in_b = left[j + 1][1] if j + 1 < len(left) else NEVER
                if across == in_a == in_b == NEVER:
                    known = True
                    break
                if in_a <= across and in_a <= in_b:
                    i += 1
                elif in_b < across:
                    j += 1
                else:
                    known = False
                    break
            if len(self.pairs) >= CACHED:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def first(self) -> Window:
        """The window at the start of a text, where END leads."""
        return self.kept(ENDED, [(0, self.trie, "")])

    def kept(self, code: int, live: list[tuple[int, dict, str]]) -> Window:
        """One window for all places where the stream goes on in the same way."""
        key = tuple((id(node), piece) for _, node, piece in live)
        window = self.windows.get(key)
        if window is None:
            window = self.windows[key] = Window(self, code, live)
        return window

    def step(self, window: Window, c: str) -> Window:
        """The window behind a next character: each live place sends out the piece that now ends, and the one that may stand behind the survivor there survives."""
        self.steps += 1
        if c == END:
            return self.first()
        survivor, live = None, []
        for back, node, before in window.live:
            if not back and before and before[-1] + c not in self.inner:
                before = ""  # whatever it is, no merge reaches over to c
            node = node.get(c)
            piece = (node.get(0) if node else None) if back else c
            if survivor is None and piece and (not before or self.beside(before, piece)):
                survivor = piece
            if node and any(node):
                live.append((back + 1, node, before))
        return self.kept(self.ids.get(survivor, len(self.texts) + ord(c)), [*live, (0, self.trie, survivor)])

    def bound(self) -> None:
        """Beyond STEPS remembered steps the windows are made anew, so that memory is bounded."""
        if self.steps > STEPS:
            for window in self.windows.values():
                window.clear()
            self.windows.clear()
            self.steps = 0

    def ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all codes, the number of ids of each): a piece's own, the bytes of a character that is no piece, none for an end."""
        size = (codes >= 0).astype(np.int64)
        odd = codes >= len(self.texts)
        if not odd.any():
            return codes[codes >= 0], size
        chars, which = np.unique(codes[odd], return_inverse=True)
        spelled = [self.id_list(chr(c - len(self.texts))) for c in chars.tolist()]
        size[odd] = np.array(list(map(len, spelled)))[which]
        flat = np.concatenate((np.arange(len(self.texts)), *spelled))  # each piece's id, then those of the characters
        at = np.maximum(codes, 0).astype(np.int64)
        at[odd] = (len(self.texts) + np.cumsum([0, *map(len, spelled[:-1])]))[which]
        upto = np.cumsum(size)
        return flat[np.repeat(at - upto + size, size) + np.arange(upto[-1])].astype(np.int32), size

    def id_list(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]


class Window(dict):
    """All that decides how a stream goes on from a place; by each next character that was met, the window it becomes.

    code is that of the place's survivor, the piece that ends there. live has the places from which a piece
    can still reach on, oldest first and at last the place itself: (how far back, node of the trie, survivor).
    """

    __slots__ = ("code", "live", "p")

    def __init__(self, p: Pieces, code: int, live: list[tuple[int, dict, str]]) -> None:
        self.p, self.code, self.live = p, code, live

    def __missing__(self, c: str) -> Window:
        self[c] = window = self.p.step(self, c)
        return window


class Viterbi:
    """Streaming: feed() takes characters of texts, END behind each text, and gives the codes of the pieces that are certain and of the ENDs.

    A place has its survivor as soon as its character is read. Kept are the last place's window, as wide as the
    longest piece that can still reach on, and the survivors behind it up to the boundary on which the paths of
    all its live places converge; the pieces before that boundary are given out.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.p = pieces
        self.window = pieces.first()
        self.codes = np.array([self.window.code], np.int32)  # of the survivors from the committed boundary on; its own is out

    def feed(self, chars: Iterable[str]) -> np.ndarray:
        windows = list(accumulate(chars, getitem, initial=self.window))
        self.window = windows[-1]
        self.codes = np.concatenate((self.codes, np.fromiter(map(CODE, islice(windows, 1, None)), np.int32, len(windows) - 1)))
        self.p.bound()
        start = np.arange(len(self.codes)) - self.p.sizes[np.minimum(self.codes, len(self.p.texts))]
        start[0] = 0
        end = self.converged(start)
        out = self.codes[on_path(start[: end + 1])]
        self.codes = self.codes[end:]
        return out

    def converged(self, start: np.ndarray) -> int:
        """The last boundary on the paths of all live places."""
        heads = {len(start) - 1 - back for back, _, _ in self.window.live}
        while len(heads) > 1:  # the last one goes back by its piece, until the paths are one
            i = max(heads)
            heads.remove(i)
            heads.add(int(start[i]))
        return heads.pop()


def on_path(start: np.ndarray) -> np.ndarray:
    """The places, without the first, on the path that ends at the last; start: where each place's survivor starts.

    A place into which no survivor reaches from before is on it, so the path is followed from all of these at once.
    """
    on = np.append(np.minimum.accumulate(start[:0:-1])[::-1] >= np.arange(len(start) - 1), True)
    heads = np.flatnonzero(on)
    while len(heads):
        heads = start[heads]
        heads = heads[~on[heads]]
        on[heads] = True
    on[0] = False
    return np.flatnonzero(on)


def encode_texts(p: Pieces, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, one after the other; the number of ids of each text; whether no character is unknown); a null text counts as empty.

    All texts are one stream through the Viterbi, END by END.
    """
    chars = chain.from_iterable(chain(p.prefix + x.replace(" ", SPACE) if x else "", (END,)) for x in texts.to_pylist())
    v, found = Viterbi(p), [np.zeros(0, np.int32)]
    while some := list(islice(chars, STRETCH)):
        found.append(v.feed(some))
    codes = np.concatenate(found)
    ids, size = p.ids_of(codes)
    ends = np.flatnonzero(codes == ENDED)
    lost = np.concatenate(([0], np.cumsum(codes >= len(p.texts)) * (not p.byte_ids)))
    upto = np.concatenate(([0], np.cumsum(size)))
    first = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return ids, upto[ends] - upto[first], lost[ends] == lost[first]


def encode_text(p: Pieces, text: str) -> np.ndarray:
    """The ids of a whole text."""
    return encode_texts(p, pa.array([text], pa.string()))[0]


def whole_text(p: Pieces, ids: list[int] | array | np.ndarray) -> str:
    """The text of ids with the space before it, if there is one: pieces, runs of bytes as UTF-8 (U+FFFD for broken ones), nothing for control ids."""
    if p.high.isdisjoint(ids):
        return "".join(map(p.texts.__getitem__, ids))
    out: list[str] = []
    run = bytearray()
    for i in ids:
        if i in p.high:
            run.append(p.bytes_of[i])
            continue
        if run:
            out.append(run.decode("utf-8", "replace"))
            run.clear()
        out.append(p.texts[i])
    out.append(run.decode("utf-8", "replace"))
    return "".join(out)


def decode_ids(p: Pieces, ids: list[int] | array | np.ndarray) -> str:
    text = whole_text(p, ids)
    return text.removeprefix(" ") if p.prefix else text


def part_sizes(texts: pa.Array) -> list[int]:
    """Numbers of rows that have about CHUNK bytes together, or one row that has more."""
    out, size = [0], 0
    for n in pc.fill_null(pc.binary_length(texts), 0).to_pylist():
        if out[-1] and size + n > CHUNK:
            out.append(0)
            size = 0
        out[-1] += 1
        size += n
    return out if out[-1] else []


LOADED: dict[int, Pieces] = {}


def loaded(proto: bytes) -> Pieces:
    """Once for a worker process."""
    key = hash(proto)
    if key not in LOADED:
        LOADED.clear()
        LOADED[key] = Pieces(proto)
    return LOADED[key]


def encode(docs: DataFrame, model: str, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, ids, n_ids, exact, keep...) for each row of docs; model: path of a .model file that the driver can read.

    ids are SentencePiece's own for the whole text (null for a null text, none for an empty one). exact tells
    whether decoding them gives the text again; U+2581 itself comes back as a space. Each row stands alone:
    no shuffle, batch by batch, with bounded caches. The model's bytes are broadcast (half a megabyte).
    """
    ship(docs)
    with open(model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = loaded(shared.value)
        for whole in batches:
            row = 0
            for n in part_sizes(whole.column(1)):
                batch = whole.slice(row, n)
                row += n
                texts = batch.column(1)
                ids, count, exact = encode_texts(p, texts)
                ends = np.concatenate(([0], np.cumsum(count)))
                for i in np.flatnonzero(~exact).tolist():  # only then the whole is decoded
                    if texts[i].is_valid:
                        exact[i] = decode_ids(p, ids[ends[i] : ends[i + 1]].tolist()) == texts[i].as_py().replace(SPACE, " ")
                none = texts.is_null().to_numpy(zero_copy_only=False)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(none))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(count, mask=none), pa.array(exact, mask=none), *batch.columns[2:]], names=["doc_id", "ids", "n_ids", "exact", *keep])

    kinds = dict(docs.dtypes)
    return docs.select("doc_id", "text", *keep).mapInArrow(run, ", ".join([f"doc_id {kinds['doc_id']}, ids array<int>, n_ids long, exact boolean", *(f"{c} {kinds[c]}" for c in keep)]))


def decode(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    ship(rows)
    with open(model, "rb") as f:
        shared = rows.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = loaded(shared.value)
        for batch in batches:
            texts = [None if x is None else decode_ids(p, x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")
