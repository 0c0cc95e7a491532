"""Byte-level BPE: whole texts to ids by a rank file, and ids back to bytes.

A text of up to :data:`CHUNK_CHARS` characters is one chunk. A longer one is cut into chunks
that overlap; each is split into pre-tokens from its own start, in parallel, which may begin
in the middle of one. The pattern has no memory: once two splits of a text share a border,
they agree from there on. So two neighbouring chunks are stitched at the first border both
have in their overlap (after a character that is not white space), and the pieces between such borders are encoded, again in parallel.
A text with an overlap in which no border is shared (one pre-token fills it) is encoded whole
by one task.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfstream.llm.common import keep, read_table, small_batches

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
#: Pre-tokens, and words, whose ids a worker remembers, and the longest of them.
CACHED_TOKENS = 400_000
CACHED_LENGTH = 64
#: A pattern by which a text may be cut before each space that no white space follows: such a
#: space begins a token, and no token looks at what was before it.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Rows and bytes of texts encoded at once.
_BATCH_ROWS, _BATCH_BYTES = 2000, 3 << 20
# Pre-tokens merged at once, and the longest of them in bytes.
_TOGETHER = 2048
_TOGETHER_LENGTH = 255

# The pattern looks at most this far past the end of a pre-token ("'re" after "'").
_LOOK_AHEAD = 3
_NONE = 1 << 62


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts = [piece[i : i + 1] for i in range(len(piece))]
    get = ranks.get
    pairs = [get(parts[i] + parts[i + 1], _NONE) for i in range(len(parts) - 1)]
    while pairs:
        best = min(pairs)
        if best == _NONE:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], _NONE)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], _NONE)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap of pairs over a linked list, for pre-tokens of any length."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or end[j] != k:
            continue
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of least rank is merged, leftmost first, until none is."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    return (_merge_short if len(piece) < 256 else _merge_long)(piece, ranks)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Merger:
    """Merges many pre-tokens at once: one round merges the best pair of each of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self._ranks = ranks
        singles = [ranks.get(bytes([b])) for b in range(256)]
        pairs = sorted(
            (ranks[word[:k]] << 32 | ranks[word[k:]], rank)
            for word, rank in ranks.items()
            for k in range(1, len(word))
            if word[:k] in ranks and word[k:] in ranks
        )
        self._pairs, self._joined = np.array(pairs or [(-1, 0)], dtype=np.int64).T.copy()
        # A vocabulary without some byte leaves no ids to begin with.
        self._singles = None if None in singles else np.array(singles, dtype=np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
        return np.where(self._pairs[at] == wanted, self._joined[at], _NONE)

    @cached_property
    def _byte_pairs(self) -> np.ndarray:
        return self._rank(np.repeat(self._singles, 256), np.tile(self._singles, 256))

    def _together(self, pieces: list[bytes]) -> list[bytes]:
        made = [b""] * len(pieces)
        slots, length = np.arange(len(pieces)), np.array([len(p) for p in pieces])
        width = int(length.max())
        text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        text = text.reshape(len(pieces), width).astype(np.int64)
        ids = self._singles[text]
        # The rank of each id joined with the next; the last id of a row has none.
        rank = np.full(ids.shape, _NONE)
        rank[:, :-1] = self._byte_pairs[text[:, :-1] << 8 | text[:, 1:]]
        rank[np.arange(width) >= length[:, None] - 1] = _NONE
        while True:
            at = rank.argmin(axis=1)  # the leftmost of equals
            best = rank[np.arange(len(at)), at]
            more = best != _NONE
            if not more.all():
                done = ids[~more].astype("<i4")
                for slot, row, n in zip(
                    slots[~more].tolist(), done, length[~more].tolist(), strict=True
                ):
                    made[slot] = row[:n].tobytes()
                slots, length, ids, rank, at, best = (
                    x[more] for x in (slots, length, ids, rank, at, best)
                )
                if not len(slots):
                    return made
            rows, length = np.arange(len(at)), length - 1
            before = np.arange(ids.shape[1] - 1) <= at[:, None]
            ids = np.where(before, ids[:, :-1], ids[:, 1:])
            rank = np.where(before, rank[:, :-1], rank[:, 1:])
            ids[rows, at] = best
            rank[rows, at] = _NONE
            i = np.flatnonzero(at < length - 1)
            rank[i, at[i]] = self._rank(best[i], ids[i, at[i] + 1])
            i = np.flatnonzero(at > 0)
            rank[i, at[i] - 1] = self._rank(ids[i, at[i] - 1], best[i])

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers, as :func:`merge` has them."""
        made: list[bytes | None] = [None] * len(pieces)
        todo = []
        for i, piece in enumerate(pieces):
            whole = self._ranks.get(piece)
            if whole is None and self._singles is not None and len(piece) <= _TOGETHER_LENGTH:
                todo.append(i)
            else:
                ids = merge(piece, self._ranks) if whole is None else [whole]
                made[i] = np.array(ids, dtype="<i4").tobytes()
        todo.sort(key=lambda i: len(pieces[i]))
        for k in range(0, len(todo), _TOGETHER):
            slab = todo[k : k + _TOGETHER]
            for i, ids in zip(slab, self._together([pieces[i] for i in slab]), strict=True):
                made[i] = ids
        return made


class _Known:
    """Ids of texts as seen lately; the older half of them is dropped when it is full."""

    def __init__(self, most: int):
        self._most = most // 2
        self.now: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def missing(self, texts: list[str]) -> list[str]:
        """Those of the distinct ``texts`` that are not known; the others are in ``now`` after it."""
        if len(self.now) > self._most:
            self._old, self.now = self.now, {}
        absent = [t for t, ids in zip(texts, map(self.now.get, texts), strict=True) if ids is None]
        older = list(map(self._old.get, absent))
        self.now.update({t: ids for t, ids in zip(absent, older, strict=True) if ids is not None})
        return [t for t, ids in zip(absent, older, strict=True) if ids is None]

    def forget(self, texts: Iterable[str]) -> None:
        for text in texts:
            del self.now[text]


def _id_lists(rows: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
    values = np.frombuffer(b"".join(rows), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


class Encoder:
    """Pre-tokens and their ids, as one worker computes them."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self._merger = Merger(read_ranks(path))
        self._by_words = pattern == WORD_PATTERN
        self._tokens, self._words = _Known(CACHED_TOKENS), _Known(CACHED_TOKENS)

    def borders(self, text: str) -> list[int]:
        return [m.end() for m in self.pattern.finditer(text)]

    def _ids(self, split: list[list[str]]) -> list[bytes]:
        """Ids of each list of pre-tokens."""
        unseen = self._tokens.missing(list(set().union(*split)))
        known = self._tokens.now
        made = self._merger.merge([t.encode("utf-8") for t in unseen])
        known.update(zip(unseen, made, strict=True))
        joined = [b"".join(map(known.__getitem__, tokens)) for tokens in split]
        self._tokens.forget(t for t in unseen if len(t) > CACHED_LENGTH)
        return joined

    def _plain(self, texts: list[str]) -> pa.ListArray:
        return _id_lists(self._ids([self.pattern.findall(t) for t in texts]))

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it."""
        split = self.pattern.findall
        return self._ids([
            [f" {w}"] if w.isascii() and w.isalpha() else split(f" {w}") for w in words
        ])

    def encode(self, texts: pa.StringArray) -> pa.ListArray:
        """Lists of ids, of no text for NULL."""
        texts = pc.fill_null(texts, "")
        if not self._by_words or not len(texts):
            return self._plain(texts.to_pylist())
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        ends = np.concatenate([[0], pc.list_value_length(lists).to_numpy().cumsum()])
        # What begins a text has no space before it, and entries of its own after the words.
        begins, own = np.unique(at[ends[:-1]], return_inverse=True)
        at[ends[:-1]] = len(words) + own
        # White space after a space may be one token with it: such texts are encoded whole.
        unseen = [w for w in self._words.missing(words) if w and not w[0].isspace()]
        known = self._words.now
        known.update(zip(unseen, self._spaced(unseen), strict=True))
        found = list(map(known.get, words))
        self._words.forget(w for w in unseen if len(w) > CACHED_LENGTH)
        absent = [i for i, ids in enumerate(found) if ids is None] if None in found else []
        for i in absent:
            found[i] = b""
        entries = _id_lists(found)
        entries = pa.concat_arrays([entries, self._plain([words[i] for i in begins])])
        sizes = pc.list_value_length(entries).to_numpy()[at]
        offsets = np.concatenate([[0], sizes.cumsum(dtype=np.int64)])[ends]
        encoded = pa.ListArray.from_arrays(
            pa.array(offsets.astype(np.int32)), entries.take(pa.array(at)).flatten()
        )
        if not absent:
            return encoded
        unsure = np.isin(at, absent)
        whole = np.flatnonzero(np.logical_or.reduceat(unsure, ends[:-1]))
        place = np.arange(len(texts))
        place[whole] = len(texts) + np.arange(len(whole))
        again = self._plain(texts.take(pa.array(whole)).to_pylist())
        return pa.concat_arrays([encoded, again]).take(pa.array(place))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


@lru_cache(4)
def _words(path: str) -> pa.LargeBinaryArray:
    """The bytes of each id, at its place; NULL where there is no such id."""
    ranks = read_ranks(path)
    words: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for word, rank in ranks.items():
        words[rank] = word
    return pa.array(words, pa.large_binary())


def _bytes_of(ids: pa.ListArray, words: pa.LargeBinaryArray) -> pa.BinaryArray:
    # A slice shares the values of its whole batch: flatten takes its own, of no NULL list.
    pieces = words.take(ids.flatten())
    if pieces.null_count:
        raise KeyError("an id outside the vocabulary")
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    ends = pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32))
    lists = pa.ListArray.from_arrays(ends, pieces, mask=pc.is_null(ids))
    return pc.binary_join(lists, pa.scalar(b"", pa.large_binary())).cast(pa.binary())


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few bytes, and of enough rows that most words in them repeat."""
    for batch in batches:
        rows = _BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)
        yield from small_batches([batch], max(1, min(_BATCH_ROWS, rows)))


# ---------------------------------------------------------------- long texts


def _chunks(long_docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, row, seq, last, text): the chunks of each text with what follows them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            doc_id, row, text = (batch.column(c)[0].as_py() for c in ("doc_id", "_row", "text"))
            n = max(1, -(-(len(text) - overlap) // chunk))  # the last one has more than an overlap
            for k in range(n):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([row]), pa.array([k]),
                     pa.array([k == n - 1]),
                     pa.array([text[k * chunk : (k + 1) * chunk + overlap]])],
                    ["doc_id", "row", "seq", "last", "text"],
                )

    return long_docs.withColumn("_row", F.monotonically_increasing_id()).mapInArrow(
        cut, "doc_id long, row long, seq long, last boolean, text string"
    )


def _overlap_borders(
    chunks: DataFrame, path: str, pattern: str, chunk: int, overlap: int
) -> DataFrame:
    """Adds ``head`` and ``tail``: borders in a chunk's first and last stretch, from their start."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in small_batches(batches, 16):
            head, tail = [], []
            for last, text in zip(
                *(batch.column(c).to_pylist() for c in ("last", "text")), strict=True
            ):
                seen = len(text) if last else len(text) - _LOOK_AHEAD
                sure = [0, *(b for b in encoder.borders(text) if b <= seen)]
                head.append([b for b in sure if b <= overlap])
                # White space before a border is split by what follows it; no piece ends so.
                after = (b for b in sure if b >= chunk and not text[b - 1].isspace())
                tail.append([] if last else [b - chunk for b in after])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(head, kind), pa.array(tail, kind)],
                [*batch.schema.names, "head", "tail"],
            )

    return chunks.mapInArrow(
        split,
        "doc_id long, row long, seq long, last boolean, text string, "
        "head array<long>, tail array<long>",
    )


def _in_order(*columns: str) -> Column:
    """The parts of one text, in their order."""
    return F.array_sort(F.collect_list(F.struct(*columns)))


def _encode_long(docs: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    chunks = keep(_chunks(docs, chunk, overlap), "chunks")
    marked = _overlap_borders(chunks, path, pattern, chunk, overlap)
    order = Window.partitionBy("row").orderBy("seq")
    shared = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
    start = F.when(F.col("seq") == 0, F.lit(0)).otherwise(shared)
    pieces = (
        marked.withColumn("start", start)
        .withColumn("next", F.lead("start").over(order))
        .withColumn("end", F.when(F.col("last"), F.length("text")).otherwise(F.col("next") + chunk))
        .withColumn(
            "whole", F.max(F.col("start").isNull()).over(Window.partitionBy("row"))
        )
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in small_batches(batches, 16):
            texts = [
                t[s:e]
                for t, s, e in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "end")),
                                   strict=True)
            ]
            ids = encoder.encode(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row", "seq")), ids],
                ["doc_id", "row", "seq", "ids"],
            )

    columns = ["doc_id", "row", "seq", "text", "start", "end"]
    own = F.when(F.col("last"), F.col("text")).otherwise(F.substring("text", 1, chunk)).alias("text")
    joined = (
        pieces.filter("whole")
        .select("doc_id", "row", "seq", own)
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), _in_order("seq", "text").alias("c"))
        .select(
            "doc_id", "row", F.lit(0).cast("long").alias("seq"),
            F.array_join("c.text", "").alias("text"),
        )
        .withColumns({"start": F.lit(0).cast("long"), "end": F.length("text").cast("long")})
    )
    todo = pieces.filter("not whole").select(*columns).unionByName(joined.select(*columns))
    encoded = todo.mapInArrow(encode, "doc_id long, row long, seq long, ids array<int>")
    return (
        encoded.groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), _in_order("seq", "ids").alias("p"))
        .select("doc_id", F.flatten("p.ids").alias("ids"))
    )


# ---------------------------------------------------------------- operators


def encode(
    docs: DataFrame, ranks_path: str, pattern: str,
    chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(doc_id, ids array<int>) per row of ``docs``, which needs ``doc_id`` and ``text``.

    Each match of ``pattern`` is encoded by itself, without special tokens. A NULL or empty
    text has no ids; repeated rows and NULL ids stay; other columns are ignored; an empty
    table gives an empty result. ``ranks_path`` must be readable on every machine.
    """
    if overlap_chars > chunk_chars:
        raise ValueError("the overlap is longer than a chunk")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.length("text") > chunk_chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in _bounded(batches):
            ids = encoder.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    short = plain.filter(~F.coalesce(is_long, F.lit(False)))
    long = _encode_long(plain.filter(is_long), ranks_path, pattern, chunk_chars, overlap_chars)
    return short.mapInArrow(run, "doc_id long, ids array<int>").unionByName(long)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """All columns but ``ids`` (array<int>), with the bytes the ids stand for as ``decoded``.

    NULL ids decode to NULL, no ids to no bytes; an id outside the vocabulary is an error.
    """
    carried = [c for c in encoded.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(ranks_path)
        for batch in small_batches(batches, 500):
            made = _bytes_of(batch.column("ids"), words)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), made],
                [*carried, "decoded"],
            )

    kinds = {f.name: f.dataType for f in encoded.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c].simpleString()}" for c in carried), "decoded binary"])
    return encoded.select(*carried, "ids").mapInArrow(run, schema)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded, and both digested."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = encode(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    counted = ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(counted, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
