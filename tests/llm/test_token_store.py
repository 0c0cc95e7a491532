"""Token files: exact round trip, random access, order and edge cases."""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfstream.llm.token_store import (
    PieceEncoder,
    TokenFile,
    op1_token_output,
    pack,
    read_tokens,
    write_tokens,
)
from shelfstream.storage import work_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, ids string, start int"

STRANGE = [
    None, "", " ", "\n\n", "a  b", " a\n\n b\t c ", "a\x1cb !\x1c! c", "x　 y  z", "  q",
    "it's we'll  'tis", "<|endoftext|> end", "no_break" * 5000, "é" * 3000 + "  " * 900 + "z",
    "12345 67 890", "日本語 テスト\r\n", "👩‍👩‍👧 ok", "\x85 a\x85", "tail  ", "a\x1f b\n!\x1e",
]


@pytest.fixture(scope="module")
def plain():
    made = Tokenizer.from_file(TOKENIZER)
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def _file(ids, doc_ids, counts):
    raw = b"".join(pack(np.array(ids, dtype=np.uint32), doc_ids, counts))

    return TokenFile(pa.BufferReader(raw))


def test_every_id_is_addressable():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 256, 700), rng.integers(0, 1 << 16, 2000),
                          rng.integers(0, 1 << 32, 400), [0, 255, 256, 65535, 65536, 2**32 - 1]])
    file = _file(ids, [1, None], [len(ids) - 5, 5])
    assert [file[i] for i in range(len(ids))] == ids.tolist()
    for a, b in ((0, len(ids)), (511, 513), (700, 700), (1024, 2049), (3000, len(ids))):
        assert file.ids(a, b).tolist() == ids[a:b].tolist()
    assert file.documents()[0] == [1, None]
    with pytest.raises(IndexError):
        file[len(ids)]


def test_all_small_ids_need_one_level():
    file = _file([1, 2, 3], [7], [3])
    assert (file._n_levels, [file[i] for i in range(3)]) == (1, [1, 2, 3])


def test_a_foreign_file_is_refused():
    with pytest.raises(ValueError):
        TokenFile(pa.BufferReader(io.BytesIO(b"x" * 64).read()))


def test_pieces_encode_as_whole_texts(plain):
    texts = [t or "" for t in STRANGE]
    got = PieceEncoder(TOKENIZER, PATTERN).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain(t) for t in texts]


@pytest.mark.parametrize("ids_per_file", [1 << 20, 50])
def test_round_trip_with_strange_rows(spark, plain, ids_per_file):
    rows = [(i * 3, t, "clash", 9) for i, t in enumerate(STRANGE)]
    rows += [(None, "null id", "", 0), (3, "equal id", "", 0), (3, "equal id", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    root = work_dir(spark, "tokens")
    manifest = write_tokens(docs, root, TOKENIZER, PATTERN, ids_per_file=ids_per_file)
    got = read_tokens(spark, root, manifest).orderBy("start").collect()
    assert sorted((r.doc_id or -1, bytes(r.ids)) for r in got) == sorted(
        (r[0] or -1, np.array([*plain(r[1]), 2], dtype="<u4").tobytes()) for r in rows
    )
    assert got[0].doc_id is None
    assert [r.doc_id for r in got[1:]] == sorted(r[0] for r in rows if r[0] is not None)
    ends = np.cumsum([r.n_tokens for r in got])
    assert [r.start for r in got] == [0, *ends[:-1]]


def test_no_documents(spark):
    root = work_dir(spark, "tokens")
    manifest = write_tokens(spark.createDataFrame([], SCHEMA), root, TOKENIZER, PATTERN)
    assert read_tokens(spark, root, manifest).collect() == []


def test_query(spark, plain, sf_dir):
    got = op1_token_output(spark, sf_dir).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy(F.col("doc_id")).collect()
    start = 0
    for row, doc in zip(got, docs, strict=True):
        ids = np.array([*plain(doc.text), 2], dtype="<u4")
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
