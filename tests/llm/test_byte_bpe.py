"""Ids as the tiktoken library gives them, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from shelfstream.llm import byte_bpe
from shelfstream.llm.byte_bpe import decode, encode, op3_byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

STRANGE = [
    None, "", " ", "\n \n", "a  b   c", "it's we'll 're''re 'r", "<|endoftext|>", "x\x1cy \x1d z",
    "日本語  テスト　全角", "👩‍👩‍👧👍🏽 ok", "a" * 700, "ab" * 900, "12 345  67890", "\t\tindent\n\n\nend  ",
]


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(PATH)
    made = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: made.encode_ordinary(text or "")


def _random_text(rng, n):
    pieces = ["a", "b", "re", "'", "'s", " ", "  ", "\n", "7", "42", "é", "語", "!", "?!", "👍", "\t"]
    return "".join(rng.choice(pieces) for _ in range(n))


def test_both_merges_agree():
    ranks, rng = byte_bpe.read_ranks(PATH), random.Random(2)
    for _ in range(200):
        piece = "".join(rng.choice("aabbcdest ") for _ in range(rng.randint(1, 60))).encode()
        if piece not in ranks:
            assert byte_bpe._merge_short(piece, ranks) == byte_bpe._merge_long(piece, ranks)


def test_many_pieces_merge_at_once():
    """Tokens that are new to a worker share the rounds of their merges."""
    ranks, rng = byte_bpe.read_ranks(PATH), random.Random(3)
    pieces = ["".join(rng.choice("aabbcdeést 語") for _ in range(rng.randint(1, 60))).encode()
              for _ in range(5000)] + [b"a" * n for n in (254, 255, 256, 700)]
    got = byte_bpe.Merger(ranks).merge(pieces)
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == [byte_bpe.merge(p, ranks) for p in pieces]
    few = {b"a": 0, b"b": 1, b"ab": 2, b"aba": 3}
    assert np.frombuffer(byte_bpe.Merger(few).merge([b"ababb"])[0], "<i4").tolist() == [2, 2, 1]


def test_words_are_looked_up_once(library, monkeypatch):
    """A batch meets each of its words once, and words of earlier batches not again."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé", k=6)) + rng.choice(["", ".", "'s"]) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(100)]
    encoder = byte_bpe.Encoder(PATH, PATTERN)
    seen = []
    monkeypatch.setattr(encoder, "_spaced", lambda w, old=encoder._spaced: seen.extend(w) or old(w))
    for _ in range(2):
        got = encoder.encode(pa.array([*texts, None, "two  spaces ", " \n x"]))
        assert got.to_pylist() == [library(t) for t in [*texts, None, "two  spaces ", " \n x"]]
    assert len(seen) == len(set(seen)) and set(words) <= set(seen)


def test_spaces_between_words(library, monkeypatch):
    """Words cut at spaces have the ids of the whole text, whatever white space is around."""
    monkeypatch.setattr(byte_bpe, "CACHED_TOKENS", 500)
    rng, encoder = random.Random(6), byte_bpe.Encoder(PATH, PATTERN)
    parts = ["a", "re", "'", "'s", " ", " ", "  ", "\n", "42", "é", "語", "?!", "\t", "\x1c", "\x85", "\u3000"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    for at in range(0, len(texts), 300):
        part = texts[at : at + 300]
        assert encoder.encode(pa.array(part)).to_pylist() == [library(t) for t in part]


def test_ids_outside_the_vocabulary(spark):
    for ids in ([5, -1], [10_000_000], [None]):
        wrong = spark.createDataFrame([(1, [7]), (2, ids)], "n long, ids array<int>")
        with pytest.raises(Exception, match="vocabulary|out of bounds"):
            decode(wrong, PATH).collect()


def test_strange_rows(spark, library):
    rows = [(i, t, 1, "x") for i, t in enumerate(STRANGE)] + [(None, "null id", 1, ""), (1, "", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = encode(docs, PATH, PATTERN)
    key = lambda r: str(r)
    assert sorted(((r.doc_id, list(r.ids)) for r in got.collect()), key=key) == sorted(
        ((r[0], library(r[1])) for r in rows), key=key
    )
    back = sorted(((r.doc_id, bytes(r.decoded)) for r in decode(got, PATH).collect()), key=key)
    assert back == sorted(((r[0], (r[1] or "").encode()) for r in rows), key=key)
    assert encode(docs.limit(0), PATH, PATTERN).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "n long, ids array<int>")
    assert sorted((r.n, r.decoded) for r in decode(nothing, PATH).collect()) == [(1, None), (2, b"")]


def test_long_texts_are_stitched(spark, library):
    """Chunks of 60 characters: overlaps fall on every kind of border, and some have none."""
    rng = random.Random(5)
    texts = [_random_text(rng, rng.randint(40, 400)) for _ in range(60)]
    texts += ["a" * 300, " " * 500, "x" + " " * 130 + "y", "word " * 60, "ab'll " * 40, "a" * 61, "é" * 65]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = encode(docs, PATH, PATTERN, chunk_chars=60, overlap_chars=14)
    assert {r.doc_id: list(r.ids) for r in got.collect()} == dict(enumerate(map(library, texts)))


def test_repeated_long_rows_stay(spark, library):
    text = "some words again and again " * 9
    docs = spark.createDataFrame([(4, text), (4, text), (None, text)], "doc_id long, text string")
    got = encode(docs, PATH, PATTERN, chunk_chars=50, overlap_chars=10).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "4", "None"]
    assert all(list(r.ids) == library(text) for r in got)


def test_query(spark, library, sf_dir):
    got = {r.doc_id: tuple(r)[1:] for r in op3_byte_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library(doc.text)
        text = hashlib.sha256(doc.text.encode()).hexdigest()
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc.doc_id] == (len(ids), listed, text)
