"""op6: whole texts go through the streaming Viterbi, which finds by itself where its paths converge."""

import io
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from citeloom.llm import sentencepieces
from citeloom.llm.queries import TOKENIZERS

with open(f"{TOKENIZERS}/piece_bpe_32k.model", "rb") as f:
    PROTO = f.read()
TEXTS = ["The cat sat on the mat", None, "", "The cat sat on the mat", " two  spaces \nand a line ", "한국あ🎉 é", "ingtheoun" * 40, "a" * 100, " " * 50, "x▁y"]


def trained(vocab_size=80, **more):
    """A small model, with pieces over the ends of words if it does not split by white space."""
    r, out = random.Random(3), io.BytesIO()
    lines = [" ".join(r.choice(["of", "the", "in", "a", "cat", "sat", "on"]) for _ in range(12)) for _ in range(400)]
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_writer=out, model_type="bpe", vocab_size=vocab_size, hard_vocab_limit=False, normalization_rule_name="identity", remove_extra_whitespaces=False, minloglevel=2, **more
    )
    return out.getvalue()


def checked(proto, texts):
    sp, p = sentencepiece.SentencePieceProcessor(model_proto=proto), sentencepieces.Pieces(proto)
    ids, count, _ = sentencepieces.encode_texts(p, pa.array(texts, pa.string()))
    want = [sp.encode((x or "").replace("▁", " ")) for x in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == want


def test_whole_texts_are_streamed(monkeypatch):
    fed = []
    feed = sentencepieces.Viterbi.feed

    def watched(self, chars):
        chars = list(chars)
        fed.extend(chars)
        return feed(self, chars)

    monkeypatch.setattr(sentencepieces.Viterbi, "feed", watched)
    checked(PROTO, TEXTS)
    assert "".join(fed) == "".join("▁" + x.replace(" ", "▁") for x in TEXTS if x)


def test_given_out_as_soon_as_paths_converge():
    v = sentencepieces.Viterbi(sentencepieces.Pieces(PROTO))
    given = [len(v.feed(c)) for c in "▁the▁cat▁sat▁on▁the▁mat▁"]
    assert sum(given) == 6 and given.count(0) >= 18 and len(v.codes) <= 2


@pytest.mark.parametrize("stretch,steps", [(1, 10**6), (7, 20), (10**6, 0)])
def test_stretches_and_new_windows_change_nothing(monkeypatch, stretch, steps):
    monkeypatch.setattr(sentencepieces, "STRETCH", stretch)
    monkeypatch.setattr(sentencepieces, "STEPS", steps)
    r = random.Random(2)
    checked(PROTO, [*TEXTS, *("".join(r.choice("ab th\n  éü한あ🎉xyzing.,") for _ in range(r.randrange(60))) for _ in range(100))])


@pytest.mark.parametrize("more", [{"split_by_whitespace": False}, {"split_by_whitespace": False, "add_dummy_prefix": False, "byte_fallback": True, "vocab_size": 340}])
def test_pieces_over_words(more, monkeypatch):
    proto = trained(**more)
    monkeypatch.setattr(sentencepieces, "STRETCH", 50)
    r = random.Random(4)
    checked(proto, [" ".join(r.choice(["of", "the", "in", "a", "cat", "sat", "theof", "ofa"]) for _ in range(r.randrange(30))) for _ in range(100)])
