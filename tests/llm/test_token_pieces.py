"""How texts are cut, and how new pieces reach the library and leave memory again."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfstream.llm import token_store
from shelfstream.llm.token_store import PieceEncoder, _of_bytes, _pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
PARTS = [
    " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", " ", " ",
    " ", "　", "あ", "た", "。", "…", "’s", "'s", "'ll", "don't", ".", "!?", "(", "_", "word",
    "The", "é", "слово", "ÿ", "１２", "½", "7", "x9", "🙂", "́", "\x00", "<|", "endoftext",
]


class Counted:
    """A model that counts its calls."""

    def __init__(self, model):
        self._model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self._model.tokenize(text)


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


@pytest.fixture
def encoder():
    return PieceEncoder(PATH, PATTERN, added=True)


def _words(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghij", k=12)) for _ in range(n)]


def _same(got, texts, library):
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library(t) for t in texts]


def test_new_words_share_calls_of_the_model(encoder, library):
    encoder._model = Counted(encoder._model)
    words = _words(3000)
    texts = [" ".join(words[i : i + 50]) for i in range(0, 3000, 50)]
    _same(encoder.encode(texts), texts, library)
    assert encoder._model.calls <= 3000 / token_store.WORDS_A_CALL + 2
    encoder._model.calls = 0
    _same(encoder.encode(texts[::-1]), texts[::-1], library)
    assert encoder._model.calls == 0


def test_memory_of_pieces_is_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(token_store, "CACHED_PIECES", 100)
    for seed in range(8):
        texts = [" often " + " ".join(_words(90, seed)), "long" * 500 + " " + "é" * 200]
        _same(encoder.encode(texts), texts, library)
        assert len(encoder._known) == len(encoder._known_ids) == len(encoder._used) <= 200
    known = encoder._known.to_pylist()
    assert " often" in known
    assert max(len(p.encode()) for p in known) <= token_store.REMEMBERED_BYTES


def test_words_alone_where_no_byte_can_part_them(encoder, library):
    encoder._words_a_call, encoder._border = 1, 0xFFFFFFFF
    texts = ["some words, don't  part ", "", "é 12"]
    _same(encoder.encode(texts), texts, library)


def test_any_parts_in_any_order(encoder, library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(12))) for _ in range(4000)]
    _same(encoder.encode(texts), texts, library)


def test_cuts():
    texts = pa.array(["no", "skip", "", "a b, c", "", "é 　 d\x85 e …  f.\n"]).slice(2)
    pieces, places = _pieces(texts)
    assert pieces.to_pylist() == ["a", " b", ",", " c", "é", " 　 d\x85 e", " …", "  f", ".", "\n"]
    assert places.tolist() == [0, 0, 4, 4, 10]


def test_rows_are_taken_by_their_bytes():
    batch = pa.record_batch({"text": ["x" * n if n is not None else None for n in (3, 3, 20, None, 4, 7)]})
    assert [b.num_rows for b in _of_bytes([batch.slice(0, 0), batch], 8)] == [2, 1, 2, 1]


def test_texts_as_an_array_with_nulls(encoder, library):
    texts = ["cut off", None, "a <|endoftext|> b", "", "end"]
    _same(encoder.encode(pa.array(texts, pa.large_string()).slice(1)), texts[1:], library)
    assert encoder.encode([None, ""]) == [b"", b""]
    assert encoder.encode([]) == []
