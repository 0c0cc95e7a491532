"""Added tokens in texts: the ids of the library as it comes."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfstream.llm.token_store import PieceEncoder, op1_token_output

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [
    f"a {END} b", f"x{END}y", END, f"{END}{END}", f"  {END}  {END}\n", f"a\x1c {END} \x1f b", f"it{END}'s 12{END}34",
    f"{END[:-1]} {END[1:]}", f"<|end{END}oftext|>", END.upper(), "plain text", "", f"日本{END}　語 ",
]


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    return lambda text: made.encode(text, add_special_tokens=False).ids


def test_texts_encode_as_by_the_library(library):
    got = PieceEncoder(PATH, public_tokenizers.PATTERN, added=True).encode(TEXTS)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library(t) for t in TEXTS]
    assert library(TEXTS[0]) == [64, 220, 50256, 275]


def test_query(spark, library, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    got = op1_token_output(spark, str(tmp_path)).orderBy("doc_id").collect()
    for row, (doc_id, text) in zip(got, rows, strict=True):
        ids = np.array([*library(text), 2], dtype="<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
