"""Archives written and read back, and files that break the format."""

from __future__ import annotations

import hashlib
import io

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from shelfstream.llm import warc
from shelfstream.llm.queries import ORACLE_SQL
from shelfstream.llm.warc import (
    ArchiveReader,
    dictionary_frame,
    op4_warc,
    parse_record,
    read_archives,
    record_bytes,
    sha1_base32,
    train_dictionary,
    write_archives,
)
from shelfstream.storage import work_dir

SCHEMA = "page_id long, url string, html string, _digest string, revisit int"
DATE = "2024-01-01T00:00:00Z"


def _archive(spark, rows, **options):
    pages = spark.createDataFrame(rows, SCHEMA)
    root = work_dir(spark, "archives")
    files = write_archives(pages, root, date=DATE, **options)
    return read_archives(files, root).collect(), files.collect()


def _want(rows, min_bytes=0):
    """(id, bytes, digest, type, refers to) per row by a plain loop."""
    by_payload = {}
    for i, (page_id, _, html, *_) in enumerate(rows):
        by_payload.setdefault((html or "").encode(), []).append((page_id is not None, page_id or 0, i))
    out = []
    for payload, found in by_payload.items():
        top = max(found)
        for has, page_id, i in found:
            own = page_id if has else ""
            first = (has, page_id, i) == top or len(payload) < min_bytes
            refers = None if first else f"<urn:page:{top[1] if top[0] else ''}>"
            out.append((f"<urn:page:{own}>", len(payload), sha1_base32(payload),
                        "response" if first else "revisit", refers, payload if first else None))
    return sorted(out, key=str)


def _got(records):
    assert [r.error for r in records] == [None] * len(records)
    return sorted(
        ((r.record_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to,
          None if r.payload is None else bytes(r.payload)) for r in records), key=str)


ROWS = [
    (1, "http://a/ b\r\nX: y", "same é", "c", 1), (9, None, "same é", "c", 1), (4, "u", "same é", "c", 1),
    (2, "u", None, "", 0), (3, "u", "", "", 0), (None, "u", "", "", 0), (None, "v", "alone", "", 0),
    (7, "u", "twice", "", 0), (7, "u", "twice", "", 0), (8, "u", "\r\n\r\nx\r\n\r\n" * 3, "", 0),
    (10, "u", "long " * 200_000, "", 0), (None, "u", "nulls", "", 0), (None, "u", "nulls", "", 0),
]


@pytest.mark.parametrize("min_bytes", [0, 5, 100])
def test_round_trip_with_strange_rows(spark, min_bytes):
    records, files = _archive(spark, ROWS, min_bytes=min_bytes)
    assert _got(records) == _want(ROWS, min_bytes)
    assert sum(f.n_records for f in files) == len(ROWS)


def test_small_files(spark):
    records, files = _archive(spark, ROWS, bytes_per_file=300)
    assert _got(records) == _want(ROWS)
    assert len(files) > 3


def test_no_pages(spark):
    assert _archive(spark, []) == ([], [])


def test_a_dictionary_leads_each_file(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.concat(F.lit("<p>"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40)).alias("html"),
    )
    dictionary = train_dictionary(pages)
    assert dictionary[:4] == warc._DICTIONARY_MAGIC
    root = work_dir(spark, "archives")
    files = write_archives(pages, root, date=DATE)
    assert read_archives(files, root).filter("error is null").count() == 3000
    codec = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    raw = dictionary_frame(dictionary) + codec.compress(b"one") + codec.compress(b"two" * 9)
    assert raw[:4] == b"\x5d\x2a\x4d\x18"
    assert list(ArchiveReader(io.BytesIO(raw))) == [b"one", b"two" * 9]


def _frames(*records):
    return b"".join(zstandard.ZstdCompressor().compress(r) for r in records)


def test_broken_records_are_reported():
    good = record_bytes(5, "u", b"payload", None, False, DATE)
    cases = {
        "version": good.replace(b"WARC/1.1", b"WARC/9.9"),
        "headers": good.replace(b"WARC-Date: " + DATE.encode() + b"\r\n", b""),
        "length": good.replace(b"payload\r\n\r\n", b"payloa\r\n\r\n"),
        "tail": good[:-2],
        "digest": good.replace(b"payload", b"PAYLOAD"),
    }
    for broken in cases.values():
        with pytest.raises(ValueError):
            parse_record(broken)
    rows = list(warc._rows_of(io.BytesIO(_frames(good, cases["digest"], good)), "f"))
    assert [r.get("error") is None for r in rows] == [True, False, True]
    cut = _frames(good, good)[:-9]
    rows = list(warc._rows_of(io.BytesIO(cut), "f"))
    assert [(r["place"], r.get("error") is None) for r in rows] == [(0, True), (1, False)]
    rows = list(warc._rows_of(io.BytesIO(_frames(good) + b"junk that is no frame"), "f"))
    assert [r.get("error") is None for r in rows] == [True, False]
    short = dictionary_frame(b"\x37\xa4\x30\xec" + b"d" * 90)[:20]
    assert list(warc._rows_of(io.BytesIO(short), "f"))[0]["error"]


def test_query_equals_sql(spark, sf_dir):
    got = op4_warc(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_dir}/pages.parquet')")
    want = con.execute(ORACLE_SQL["op4_warc"])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_digest_is_bare_base32():
    assert sha1_base32(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert len(sha1_base32(b"x")) == 32 and hashlib.sha1(b"").digest_size == 20
