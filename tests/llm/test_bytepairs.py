"""Byte-level BPE against the tokenizer library, and back."""

import base64
import hashlib
import random
from pathlib import Path

import pytest
import tiktoken

from citeloom.llm import bytepairs, queries

RANKS = f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Contractions and their neighbours, white space of all kinds, letters, digits and marks of one to four bytes.
SIGNS = ["'", "s", "t", "r", "e", "v", "l", "d", "m", "ll", "'ve", " ", "  ", "\n", "\t", "\xa0", "　", "a", "B", "é", "1", "٣", "½", "!", "-", "中", "🙂", "́", "‍", "\x00", "\x1c", "\x85", "ſ", "K"]


@pytest.fixture(scope="module")
def vocabulary():
    return bytepairs.Vocabulary(Path(RANKS).read_bytes(), bytepairs.class_table())


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def parts(ids, count):
    at = 0
    for n in count:
        yield ids[at : at + n].tolist()
        at += n


def test_random_texts(vocabulary, library):
    rnd = random.Random(5)
    for i in range(6000):
        few = rnd.sample(SIGNS, rnd.randint(1, 6))
        texts = ["".join(rnd.choice(few if rnd.random() < 0.8 else SIGNS) for _ in range(rnd.randint(0, 300 if i % 50 == 0 else 30))) for _ in range(rnd.randint(1, 4))]
        assert list(parts(*vocabulary.encoded([t.encode() for t in texts]))) == [library.encode_ordinary(t) for t in texts], texts


def test_windows_of_a_long_text(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bytepairs, "WINDOW", 20)
    rnd = random.Random(6)
    for _ in range(1500):
        text = "".join(rnd.choice(SIGNS[: rnd.choice((12, len(SIGNS)))]) for _ in range(rnd.randint(21, 200)))
        assert vocabulary.encoded([text.encode()])[0].tolist() == library.encode_ordinary(text), text
    text = "x" * 500 + " " * 300 + "y"  # slices longer than a window
    assert vocabulary.encoded([text.encode()])[0].tolist() == library.encode_ordinary(text)


def test_blocks_without_a_constant_class(vocabulary, library):
    """Only letters of contractions and apostrophes: the maps of blocks are composed."""
    rnd = random.Random(7)
    for _ in range(300):
        text = "".join(rnd.choice("'relv") for _ in range(rnd.randint(100, 700)))
        assert vocabulary.encoded([text.encode()])[0].tolist() == library.encode_ordinary(text), text


def test_both_ways_of_merging(vocabulary):
    rnd = random.Random(8)
    for _ in range(2000):
        piece = "".join(rnd.choice("abcdeé中-=") for _ in range(rnd.randint(2, 40))).encode()
        if piece not in vocabulary.ranks:
            assert bytepairs.merged(piece, vocabulary.ranks) == bytepairs.merged_long(piece, vocabulary.ranks)


def test_query_of_all_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op13_byte_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_nulls_empties_repeats_long_texts_and_more_columns(spark, library):
    long = "word's 中 " * 400_000
    rows = [(1, None, 1), (None, "", 2), (2, "it's", 3), (2, "it's", 3), (3, long, 4), (None, " \n ", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(2)
    encoded = bytepairs.encode(docs, RANKS)
    got = sorted((r.doc_id or 0, r.ids) for r in encoded.collect())
    assert got == sorted((i or 0, library.encode_ordinary(t or "")) for i, t, _ in rows)
    back = bytepairs.decode(encoded, RANKS, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, bytes(r.bytes)) for r in back) == sorted((i or 0, (t or "").encode()) for i, t, _ in rows)
    assert bytepairs.encode(docs.limit(0), RANKS).collect() == []
    # a slice of both lists gives its part of the text, and null lists give null
    part = encoded.where("doc_id = 2").limit(1).selectExpr("slice(ids, 2, 1) AS ids", "slice(offsets, 2, 1) AS offsets")
    assert [bytes(r.bytes) for r in bytepairs.decode(part, RANKS).collect()] == [b"'s"]
    none = spark.createDataFrame([(None, None), ([], [])], "ids array<int>, offsets array<int>")
    assert sorted((r.bytes is None, bytes(r.bytes or b"")) for r in bytepairs.decode(none, RANKS).collect()) == [(False, b""), (True, b"")]


def test_ranks_are_a_parameter(spark):
    ranks = f"{queries.TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(ranks).read_bytes().splitlines())}
    text = "el niño 中文 don't"
    got = bytepairs.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), ranks).first()
    assert got.ids == tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=known, special_tokens={}).encode_ordinary(text)
