"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits, lowest first. Level 0 holds the first chunk of every
id, level k the k-th chunk of those ids that have one. A bitmap per level tells which ids go
on to the next level, and a directory of counts, one per 512 bits, turns "the i-th id of this
level" into "its place in the next" by one look-up and a count of at most 64 bytes. Any id is
therefore read with a few bytes per level, and nothing is decoded around it.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfstream.llm.common import Store, keep, read_table
from shelfstream.storage import work_dir

END_ID = 2
#: A file is closed once it holds this many ids; a document is never cut.
IDS_PER_FILE = 1 << 23
#: Pieces of text whose ids a worker always remembers, those used last; twice as many at most.
CACHED_PIECES = 100_000

_MAGIC = b"DACIDS01"
_BLOCK_BITS = 512
_BLOCK_BYTES = _BLOCK_BITS // 8
_CHUNK_BITS = 8

# Where text is cut. A token of the vocabulary's pattern never has white space
# after anything else, nor a sign after a letter or digit, so the place before ASCII white space
# that follows other text, or before an ASCII sign that follows an ASCII letter or digit, is
# always a border between tokens, and what follows is tokenised as if it stood alone.
_WHITE, _WORD, _SIGN = 1, 2, 3
_KINDS = np.array(
    [_WHITE if chr(b) in " \t\n\v\f\r" else _WORD if chr(b).isalnum() else _SIGN if 32 < b < 127 else 0
     for b in range(128)] + [0] * 128, dtype=np.uint8,
)
# The last two bytes, in UTF-8, that other white space ends with; a few other characters share them.
_WHITE_ENDS = np.zeros((256, 256), dtype=bool)
for _space in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a" \
        "\u2028\u2029\u202f\u205f\u3000":
    _WHITE_ENDS[tuple(_space.encode()[-2:])] = True
#: Bytes of texts whose pieces are looked up together; a longer text is alone.
BYTES_AT_ONCE = 4 << 20
#: Pre-tokens that go to the library's model in one call.
WORDS_A_CALL = 128
#: Longer pieces are not remembered.
REMEMBERED_BYTES = 64
# Pieces that are one token of the pattern.
_SINGLE = r"^(?: ?\pL+| ?\pN+)$"


# ---------------------------------------------------------------- the file format


def _levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """(chunks, continuation flags) of each level; the last level has no flags."""
    levels, rest = [], ids.astype(np.uint32, copy=False)
    while True:
        chunks = (rest & 0xFF).astype(np.uint8)
        rest = rest >> _CHUNK_BITS
        more = rest != 0
        if not more.any():
            levels.append((chunks, None))
            return levels
        levels.append((chunks, more))
        rest = rest[more]


def pack(ids: np.ndarray, doc_ids: list[int | None], counts: list[int]) -> Iterator[bytes]:
    """The bytes of one file: ids of consecutive documents with ``counts`` ids each."""
    sections: list[tuple[str, np.ndarray]] = [
        ("doc_id", np.array([d or 0 for d in doc_ids], dtype="<i8")),
        ("doc_null", np.array([d is None for d in doc_ids], dtype=np.uint8)),
        ("doc_end", np.cumsum(np.array(counts, dtype=np.int64)).astype("<i8")),
    ]
    levels = _levels(ids)
    for k, (chunks, more) in enumerate(levels):
        sections.append((f"chunks{k}", chunks))
        if more is not None:
            bitmap = np.packbits(more, bitorder="little")
            bitmap = np.pad(bitmap, (0, -len(bitmap) % _BLOCK_BYTES))
            ones = np.bitwise_count(bitmap).reshape(-1, _BLOCK_BYTES).sum(axis=1, dtype=np.int64)
            directory = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<i8")
            sections += [(f"bitmap{k}", bitmap), (f"directory{k}", directory)]
    at, places = 0, {}
    for name, values in sections:
        places[name] = [at, values.nbytes]
        at += values.nbytes
    header = json.dumps({"n_ids": len(ids), "n_docs": len(doc_ids), "n_levels": len(levels),
                         "sections": places}).encode()
    yield _MAGIC + len(header).to_bytes(8, "little") + header
    for _, values in sections:
        yield values.tobytes()


class TokenFile:
    """Random access to one file."""

    def __init__(self, file):
        self._file = file
        start = file.read_at(16, 0)
        if start[:8] != _MAGIC:
            raise ValueError("not a token file")
        length = int.from_bytes(start[8:16], "little")
        header = json.loads(file.read_at(length, 16))
        self._base = 16 + length
        self._places = header["sections"]
        self.n_ids, self.n_docs, self._n_levels = (
            header[k] for k in ("n_ids", "n_docs", "n_levels")
        )

    def _read(self, section: str, at: int, length: int) -> bytes:
        start, size = self._places[section]
        return self._file.read_at(min(length, size - at), self._base + start + at)

    def _rank(self, level: int, i: int) -> int:
        """How many of the first ``i`` ids of a level go on to the next."""
        block, bits = divmod(i, _BLOCK_BITS)
        directory = f"directory{level}"
        if block * 8 >= self._places[directory][1]:
            return self._places[f"chunks{level + 1}"][1]
        before = int.from_bytes(self._read(directory, block * 8, 8), "little")
        if not bits:
            return before
        part = self._read(f"bitmap{level}", block * _BLOCK_BYTES, (bits + 7) // 8)
        own = int.from_bytes(part, "little") & ((1 << bits) - 1)
        return before + own.bit_count()

    def __len__(self) -> int:
        return self.n_ids

    def __getitem__(self, i: int) -> int:
        """The id at place ``i``: one chunk, one bit and one rank per level."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for level in range(self._n_levels):
            value |= self._read(f"chunks{level}", i, 1)[0] << (_CHUNK_BITS * level)
            if level + 1 == self._n_levels:
                break
            if not self._read(f"bitmap{level}", i // 8, 1)[0] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` up to ``end``."""
        values = np.zeros(end - start, dtype=np.uint32)
        place = np.arange(end - start)
        for level in range(self._n_levels):
            if start >= end:
                break
            chunks = np.frombuffer(self._read(f"chunks{level}", start, end - start), np.uint8)
            values[place] |= chunks.astype(np.uint32) << (_CHUNK_BITS * level)
            if level + 1 == self._n_levels:
                break
            first = start // 8
            raw = np.frombuffer(self._read(f"bitmap{level}", first, (end + 7) // 8 - first), np.uint8)
            flags = np.unpackbits(raw, bitorder="little")[start - first * 8 :][: end - start]
            place = place[flags.astype(bool)]
            start = self._rank(level, start)
            end = start + len(place)
        return values

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids, and the place after the last id of each."""
        ids, nulls, ends = (
            np.frombuffer(self._read(name, 0, self._places[name][1]), kind)
            for name, kind in (("doc_id", "<i8"), ("doc_null", np.uint8), ("doc_end", "<i8"))
        )
        return [None if n else d for d, n in zip(ids.tolist(), nulls.tolist(), strict=True)], ends


# ---------------------------------------------------------------- encoding


def _byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte, for ``str.translate``.

    Printable bytes of Latin-1 stand for themselves, the others for the letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts, and where each begins and the last ends."""
    _, places, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    offsets = np.frombuffer(places, "<i4")[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pieces(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The texts cut at certain token borders, and the number of pieces before each text."""
    data, offsets = _bytes_of(texts)
    kinds = _KINDS[data]
    before, after = kinds[:-1], kinds[1:]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = (after == _WHITE) & (before != _WHITE)
    cut[1:-1] |= (after == _SIGN) & (before == _WORD)
    # a blank that may follow white space beyond ASCII is left where it is
    doubtful = np.flatnonzero(cut[1:-1] & (data[:-1] >= 0x80)) + 1
    cut[doubtful[_WHITE_ENDS[data[doubtful - 2], data[doubtful - 1]]]] = False
    cut[offsets] = True
    borders = np.flatnonzero(cut).astype("<i4")
    pieces = pa.StringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders), pa.py_buffer(data))
    return pieces, np.searchsorted(borders, offsets)


def _ids_array(ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Runs of ids as little-endian unsigned 32-bit integers."""
    places = np.concatenate([[0], ends]).astype("<i8") * 4
    buffers = [None, pa.py_buffer(places), pa.py_buffer(ids.astype("<u4"))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), buffers)


def _joined(parts: pa.LargeBinaryArray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Consecutive parts of an array without NULLs put together, up to each of ``ends``."""
    _, places, data = parts.buffers()
    offsets = np.zeros(1, dtype="<i8")
    if len(parts):
        offsets = np.frombuffer(places, "<i8")[parts.offset : parts.offset + len(parts) + 1]
    buffers = [None, pa.py_buffer(offsets[np.concatenate([[0], ends]).astype(np.int64)]), data]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), buffers)


class PieceEncoder:
    """Ids of whole texts by the tokenizers library, each distinct piece encoded once.

    A text is cut where a token border is certain, so the ids of its pieces in a row are the
    ids of the text. Arrow finds the distinct pieces of a few texts, looks them up among those
    used of late, and puts the ids together. New pieces are split into pre-tokens, which the
    library's model encodes many in a call: between two stands a byte that no merge takes in.
    With ``added``, the added tokens of the file that stand in a text are one id each, as the
    library's ``encode(text, add_special_tokens=False)`` has it; without, they are plain text.
    """

    def __init__(self, path: str, pattern: str, added: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        import regex
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if type(tokenizer.pre_tokenizer).__name__ != "ByteLevel" or tokenizer.normalizer:
            raise ValueError("not a byte-level vocabulary")
        tokens = tokenizer.get_added_tokens_decoder() if added else {}
        if any(t.single_word or t.lstrip or t.rstrip for t in tokens.values()):
            raise ValueError("added tokens that depend on what is around them")
        self._added = {t.content: array("I", [i]).tobytes() for i, t in tokens.items()}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})").split
        self._model = tokenizer.model
        self._tokens = regex.compile(pattern).findall
        letters = _byte_letters()
        self._letters = np.array([ord(letters[b]) for b in range(256)], dtype="<u4")
        # a byte that UTF-8 never has and that the vocabulary has only by itself
        joint = "".join(tokenizer.get_vocab(with_added_tokens=False))
        alone = [b for b in (0xFF, 0xFE, 0xC0) if joint.count(letters[b]) == 1]
        self._words_a_call = WORDS_A_CALL if alone else 1
        self._between = alone[0] if alone else 0xFF
        self._border = self._model.token_to_id(letters[alone[0]]) if alone else 0xFFFFFFFF
        self._known = pa.array([], pa.string())
        self._known_ids = pa.array([], pa.large_binary())
        self._used = np.zeros(0, dtype=np.int64)  # when, counted in batches
        self._now = 0

    def _encode_words(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """The ids of pre-tokens, by the library's model."""
        data, offsets = _bytes_of(words)
        ends = offsets[1:] + np.arange(len(words))  # with a byte after each word
        raw = np.full(len(data) + len(words), self._between, dtype=np.uint8)
        own = np.ones(len(raw), dtype=bool)
        own[ends] = False
        raw[own] = data
        text = self._letters[raw].tobytes().decode("utf-32-le")
        calls = [*ends[self._words_a_call - 1 : -1 : self._words_a_call].tolist(), *ends[-1:].tolist()]
        ids: list[int] = []
        start = 0
        for end in calls:
            ids += [t.id for t in self._model.tokenize(text[start:end])]
            ids.append(self._border)
            start = end + 1
        found = np.array(ids, dtype=np.uint32)
        border = found == self._border
        return _ids_array(found[~border], np.flatnonzero(border) - np.arange(len(words)))

    def _encode_pieces(self, pieces: pa.StringArray) -> pa.LargeBinaryArray:
        """The ids of pieces: those of their pre-tokens in a row."""
        single = pc.match_substring_regex(pieces, _SINGLE)
        others = list(map(self._tokens, pieces.filter(pc.invert(single)).to_numpy(zero_copy_only=False)))
        tokens = pa.array([t for ts in others for t in ts], pa.string()).dictionary_encode()
        parts = self._look_up(tokens.dictionary, self._encode_words).take(tokens.indices)
        made = [
            self._encode_words(pieces.filter(single)),
            _joined(parts, np.cumsum([len(ts) for ts in others], dtype=np.int64)),
        ]
        order = np.argsort(~single.to_numpy(zero_copy_only=False), kind="stable")
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return pa.concat_arrays(made).take(pa.array(back))

    def _look_up(self, pieces: pa.StringArray, encode) -> pa.LargeBinaryArray:
        """The ids of distinct pieces, remembered or made by ``encode``."""
        ids = self._known_ids
        at = pc.index_in(pieces, value_set=self._known)
        new = pieces.filter(pc.is_null(at))
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        self._used[at[at >= 0]] = self._now
        if len(new):
            made = encode(new)
            at[at < 0] = len(ids) + np.arange(len(new))
            ids = pa.concat_arrays([ids, made])
            short = pc.less_equal(pc.binary_length(new), REMEMBERED_BYTES)
            self._known = pa.concat_arrays([self._known, new.filter(short)])
            self._known_ids = pa.concat_arrays([self._known_ids, made.filter(short)])
            self._used = np.pad(self._used, (0, len(self._known) - len(self._used)), constant_values=self._now)
        return ids.take(pa.array(at))

    def _turn(self) -> None:
        """Forget the pieces not used for longest, once there are twice as many as wanted."""
        self._now += 1
        if len(self._known) > 2 * CACHED_PIECES:
            stay = np.sort(np.argsort(self._used, kind="stable")[-CACHED_PIECES:])
            self._known, self._known_ids = (x.take(pa.array(stay)) for x in (self._known, self._known_ids))
            self._used = self._used[stay]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        texts = texts.fill_null("")
        if not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self._added):
            return self._plain(texts)
        cut = [self._cut(text) for text in texts.to_pylist()]
        plain = iter(self._plain(pa.array([p for parts in cut for p in parts[::2]], pa.string())))
        return [
            b"".join([self._added[p] if i % 2 else next(plain) for i, p in enumerate(parts)])
            for parts in cut
        ]

    def _plain(self, texts: pa.StringArray) -> list[bytes]:
        """The ids of texts without added tokens."""
        pieces, places = _pieces(texts)
        coded = pieces.dictionary_encode()
        ids = self._look_up(coded.dictionary, self._encode_pieces).take(coded.indices)
        self._turn()
        return _joined(ids, places[1:]).to_pylist()


_ENCODERS: dict[tuple[str, str, bool], PieceEncoder] = {}


def _encoder(path: str, pattern: str, added: bool) -> PieceEncoder:
    if (path, pattern, added) not in _ENCODERS:
        _ENCODERS[path, pattern, added] = PieceEncoder(path, pattern, added)
    return _ENCODERS[path, pattern, added]


def _of_bytes(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows with ``most`` bytes of text together, or one longer row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(), dtype=np.int64)
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(first, last - first)
            first = last


_MANIFEST = "shard long, part long, file string, n_docs long, n_ids long"


def write_tokens(
    docs: DataFrame, root: str, tokenizer: str, pattern: str, end_id: int = END_ID,
    ids_per_file: int = IDS_PER_FILE, added: bool = False,
) -> DataFrame:
    """Encode the documents and write token files in ascending ``doc_id`` order below ``root``.

    ``tokenizer`` is the file of a byte-level vocabulary, ``pattern`` the one it splits text by.
    ``added`` makes one id of each added token of the file that stands in a text.

    ``docs`` needs ``doc_id`` (bigint) and ``text``; other columns are ignored. The texts are
    shuffled once, by ranges of the id. A NULL id sorts first; equal ids are ordered by a hash
    of their text, and many equal rows still spread over tasks. A NULL or empty text holds the
    end id alone. Returns one row per file (shard, part, file, n_docs, n_ids); no documents
    give no files.
    """
    ordered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("_same"),
        F.monotonically_increasing_id().alias("_row"),
    )
    keys = [F.asc_nulls_first("doc_id"), F.asc("_same"), F.asc("_row")]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = TaskContext.get().partitionId(), 0
        encoder, store = _encoder(tokenizer, pattern, added), Store(root)
        doc_ids: list = []
        counts: list[int] = []
        parts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            name = f"ids-{shard:06d}-{part:04d}.dac"
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            store.write_parts(name, pack(ids, doc_ids, counts))
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (shard, part, name, len(doc_ids), len(ids))],
                names=["shard", "part", "file", "n_docs", "n_ids"],
            )

        for batch in _of_bytes(batches, BYTES_AT_ONCE):
            for doc_id, ids in zip(
                batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")),
                strict=True,
            ):
                doc_ids.append(doc_id)
                counts.append(len(ids) // 4 + 1)
                parts += [ids, end]
                held += counts[-1]
                if held >= ids_per_file:
                    yield flush()
                    doc_ids, counts, parts, held, part = [], [], [], 0, part + 1
        if doc_ids:
            yield flush()

    return keep(ordered.select("doc_id", "text").mapInArrow(write, _MANIFEST), "token-files")


def read_tokens(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens and ``ids`` (little-endian, 32 bit).

    ``start`` counts the ids of all documents before it. Only the list of files, one row
    each, is put in order in one place; each file is read by a task of its own.
    """
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(
        "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    )
    n_files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open(row["file"]) as raw:
                    yield from _documents(TokenFile(raw), row["base"])

    return placed.repartition(n_files).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )


def _documents(file: TokenFile, base: int, at_once: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Documents of a file in batches of about ``at_once`` ids."""
    doc_ids, ends = file.documents()
    starts = np.concatenate([[0], ends[:-1]])
    first = 0
    while first < len(doc_ids):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + at_once, "right")))
        raw = file.ids(int(starts[first]), int(ends[last - 1])).astype("<u4").tobytes()
        zero = int(starts[first])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids[first:last], pa.int64()),
                pa.array(starts[first:last] + base),
                pa.array(ends[first:last] - starts[first:last]),
                pa.array([raw[(s - zero) * 4 : (e - zero) * 4] for s, e in
                          zip(starts[first:last].tolist(), ends[first:last].tolist(), strict=True)],
                         pa.binary()),
            ],
            names=["doc_id", "start", "n_tokens", "ids"],
        )
        first = last


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to token files, and its digest as read back from them."""
    import public_tokenizers

    root = work_dir(spark, "tokens")
    manifest = write_tokens(
        read_table(spark, sf_dir, "documents"), root,
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, added=True,
    )
    return read_tokens(spark, root, manifest).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
