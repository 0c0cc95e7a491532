"""Web archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

The writer gives each task its own files. The reader takes any such file: it loads the
dictionary, decodes one frame at a time, and checks version, headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import Store, keep, read_table, share_by_hash, small_batches
from shelfstream.storage import work_dir

#: A file is closed once it holds this many bytes.
BYTES_PER_FILE = 256 << 20
#: The dictionary is trained on about this many pages, this many characters of each.
SAMPLE_PAGES = 400
SAMPLE_CHARS = 8_192
DICTIONARY_BYTES = 32 << 10

# Fixed values of the archive and compression formats.
_DICTIONARY_FRAME = 0x184D2A5D
_DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
_FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
_VERSION = b"WARC/1.1"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

_READ_BYTES = 1 << 16


# ---------------------------------------------------------------- one record


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id, url, payload: bytes, refers_to, is_revisit: bool, date: str) -> bytes:
    """One record; a revisit keeps the response's header lines and leaves out the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (
        len(payload)
    )
    block = http if is_revisit else http + payload
    # An address must not break its line.
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:unknown")
    lines = [
        _VERSION.decode(),
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
    ]
    if is_revisit:
        lines += [f"WARC-Refers-To: {record_name(refers_to)}", f"WARC-Profile: {_IDENTICAL}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    found = {}
    for line in raw.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without a colon: {line[:60]!r}")
        found[name.strip().lower()] = value.strip()
    return found


def parse_record(raw: bytes) -> dict:
    """The parts of a record; ValueError says what is wrong with it."""
    head, border, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not border or version != _VERSION:
        raise ValueError("no record of this version")
    headers = _headers(lines)
    if missing := [h for h in _REQUIRED if h not in headers]:
        raise ValueError(f"missing headers {missing}")
    length = int(headers["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError("the record's length is not its Content-Length")
    digest = headers.get("warc-block-digest", "").removeprefix("sha1:")
    if digest and digest != sha1_base32(block):
        raise ValueError("the block differs from its digest")
    record = {"headers": headers, "payload": None, "payload_bytes": None}
    if headers["warc-type"] in ("response", "revisit"):
        http, border, payload = block.partition(b"\r\n\r\n")
        stated = _headers(http.partition(b"\r\n")[2])
        record["payload_bytes"] = int(stated["content-length"])
        if headers["warc-type"] == "response":
            if len(payload) != record["payload_bytes"]:
                raise ValueError("the payload's length is not its Content-Length")
            if headers.get("warc-payload-digest", "").removeprefix("sha1:") != sha1_base32(payload):
                raise ValueError("the payload differs from its digest")
            record["payload"] = payload
    return record


# ---------------------------------------------------------------- files


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary of :data:`DICTIONARY_BYTES` from a bounded sample; empty if that is too small.

    The sample is chosen by the hash of id and address, twice :data:`SAMPLE_PAGES` at the very
    most, and each partition sends its share of it only.
    """
    import zstandard

    chosen = pages.filter(
        F.col("html").isNotNull() & share_by_hash(["page_id", "url"], SAMPLE_PAGES, pages.count())
    )
    starts = chosen.select(F.substring("html", 1, SAMPLE_CHARS).alias("html"))
    texts = sorted(r.html.encode() for r in starts.limit(2 * SAMPLE_PAGES).collect())
    if sum(map(len, texts)) < 16 * DICTIONARY_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()


def dictionary_frame(dictionary: bytes) -> bytes:
    import zstandard

    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return _DICTIONARY_FRAME.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed


class ArchiveReader:
    """The decoded frames of one open file, in order."""

    def __init__(self, file):
        import zstandard

        self._file = file
        self._held = b""
        start = self._more(8)[:8]
        dictionary = None
        if len(start) == 8 and int.from_bytes(start[:4], "little") == _DICTIONARY_FRAME:
            size = int.from_bytes(start[4:], "little")
            body = self._more(8 + size)[8 : 8 + size]
            if len(body) != size:
                raise ValueError("the dictionary frame is cut short")
            if body[:4] == _FRAME_MAGIC:
                body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
            if body[:4] != _DICTIONARY_MAGIC:
                raise ValueError("the leading frame holds no dictionary")
            dictionary = zstandard.ZstdCompressionDict(body)
            self._held = self._held[8 + size :]
        self._codec = zstandard.ZstdDecompressor(dict_data=dictionary)

    def _more(self, least: int) -> bytes:
        """Read on until ``least`` bytes are held, or the file ends."""
        while len(self._held) < least:
            block = self._file.read(max(_READ_BYTES, least - len(self._held)))
            if not block:
                break
            self._held += block
        return self._held

    def __iter__(self) -> Iterator[bytes]:
        import zstandard

        while self._more(1):
            frame, parts = self._codec.decompressobj(), []
            try:
                while not frame.eof:
                    if not self._more(1):
                        raise ValueError("the last frame is cut short")
                    held, self._held = self._held, b""
                    parts.append(frame.decompress(held))
                self._held = frame.unused_data
            except zstandard.ZstdError as broken:
                raise ValueError(f"a frame cannot be decoded: {broken}") from broken
            yield b"".join(parts)


# ---------------------------------------------------------------- operators

_FILES = "file string, n_records long"


def write_archives(
    pages: DataFrame, root: str, min_bytes: int = 0, date: str | None = None,
    bytes_per_file: int = BYTES_PER_FILE,
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``root``.

    Of the rows whose html has the same bytes (NULL: empty), at least ``min_bytes`` of them,
    the one with the largest ``page_id`` becomes a response and the others revisits of it; of
    repeated rows with that id one is the response. A NULL id comes below all others. Other
    columns are ignored. Returns one row per file; no pages give no files. Very long pages are
    written whole. ``pages`` must be read from files, so that its rows come in the same order
    whenever they are read.

    Copies are counted by digest before the shuffle. The join that follows is an inner one by
    digest, whose hot partitions adaptive execution splits.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    dictionary = train_dictionary(pages)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("_row"),
    ).withColumn("_digest", F.sha2("html", 256))
    # The struct orders NULL ids first, so that any id beats them.
    last = rows.groupBy("_digest").agg(F.max(F.struct("page_id", "_row")).alias("_last"))
    small = F.octet_length("html") < min_bytes
    marked = rows.join(last, "_digest").select(
        "page_id",
        "url",
        "html",
        F.col("_last.page_id").alias("refers_to"),
        (~small & (F.col("_row") != F.col("_last._row"))).alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        store, shard = Store(root), TaskContext.get().partitionId()
        kind = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        codec = zstandard.ZstdCompressor(level=3, dict_data=kind)
        lead = [dictionary_frame(dictionary)] if dictionary else []
        parts, held, n, part = list(lead), 0, 0, 0

        def flush() -> pa.RecordBatch:
            name = f"pages-{shard:06d}-{part:04d}.warc.zst"
            store.write_parts(name, parts)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], ["file", "n_records"])

        for batch in small_batches(batches, 500):
            for row in batch.to_pylist():
                raw = record_bytes(
                    row["page_id"], row["url"], row["html"].encode(), row["refers_to"],
                    row["revisit"], date,
                )
                parts.append(codec.compress(raw))
                held, n = held + len(parts[-1]), n + 1
                if held >= bytes_per_file:
                    yield flush()
                    parts, held, n, part = list(lead), 0, 0, part + 1
        if n:
            yield flush()

    return keep(marked.mapInArrow(write, _FILES), "archive-files")


_RECORDS = (
    "file string, place long, type string, record_id string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary, error string"
)


def read_archives(files: DataFrame, root: str) -> DataFrame:
    """One row per record of the files named in column ``file``, below ``root``.

    ``payload`` is NULL for a revisit, whose ``payload_bytes`` and ``payload_digest`` are those
    of the response it refers to. A record that breaks the format comes with ``error`` set and
    the rest NULL; a frame that cannot be decoded is the last of its file. Files are read by
    tasks of their own, in blocks, a record at a time.
    """
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k])
                        for n, k in (c.split() for c in _RECORDS.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open(name) as raw:
                    rows, held = [], 0
                    for row in _rows_of(raw, name):
                        rows.append(row)
                        held += len(row.get("payload") or b"")
                        if held > 4 << 20 or len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    n_files = max(1, files.count())
    return files.select("file").repartition(n_files).mapInArrow(read, _RECORDS)


def _rows_of(raw, name: str) -> Iterator[dict]:
    place = 0
    try:
        for place, frame in enumerate(ArchiveReader(raw)):
            row = {"file": name, "place": place}
            try:
                record = parse_record(frame)
            except (ValueError, KeyError) as wrong:
                yield {**row, "error": str(wrong)}
                continue
            headers = record["headers"]
            yield {
                **row,
                "type": headers["warc-type"],
                "record_id": headers["warc-record-id"],
                "target_uri": headers.get("warc-target-uri"),
                "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                "payload_bytes": record["payload_bytes"],
                "refers_to": headers.get("warc-refers-to"),
                "payload": record["payload"],
            }
            place += 1
    except ValueError as broken:
        yield {"file": name, "place": place, "error": str(broken)}


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, and what the archives say of it."""
    root = work_dir(spark, "archives")
    files = write_archives(read_table(spark, sf_dir, "pages"), root)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).try_cast("long")
    return read_archives(files, root).select(
        number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        number(F.col("refers_to")).alias("refers_to"),
        "error",
    )


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# The digest in base 32: four times ten hexadecimal digits, eight letters of five bits each.
OP4_SQL = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digested AS (SELECT page_id, html, sha1(html) AS hex,
    max(page_id) OVER (PARTITION BY html) AS last_id FROM hashed)
SELECT page_id, cast(strlen(html) AS bigint) AS payload_bytes,
  {" || ".join(
      f"substr('{_LETTERS}', cast((cast('0x' || substr(hex, {1 + 10 * part}, 10) AS bigint) "
      f">> {35 - 5 * k}) & 31 AS int) + 1, 1)" for part in range(4) for k in range(8))}
    AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last_id THEN last_id END AS refers_to,
  cast(NULL AS varchar) AS error
FROM digested
"""
