"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.storage import work_dir


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared work folder, and read back.

    The plan above it is cut, and the rows survive the loss of any executor.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underlines before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_of_id(column: str):
    """crc32 of an id written as decimal text; NULL stays NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


_PLACES = 1 << 30


def share_by_hash(columns: list[str], most: int, n: int):
    """A condition that about ``most`` of ``n`` rows meet, the same rows at each run.

    Unlike the first rows of an order, it leaves each partition with its share only.
    """
    bound = min(_PLACES, int(most / max(1, n) * _PLACES) + 1)
    return F.pmod(F.xxhash64(*columns), F.lit(_PLACES)) < bound


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as Python strings, NULL as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Store:
    """Files of the shared folder as seen from an executor.

    ``root`` is any address pyarrow can open: ``file:``, ``hdfs:``, ``s3:``, ``gs:`` or a
    plain path.
    """

    def __init__(self, root: str):
        from pyarrow import fs

        if root.startswith("file:"):
            root = root[len("file:") :]
            root = "/" + root.lstrip("/")
        if "://" in root:
            self._fs, self._root = fs.FileSystem.from_uri(root)
        else:
            self._fs, self._root = fs.LocalFileSystem(), os.path.abspath(root)

    def write_parts(self, name: str, parts) -> None:
        """Write byte pieces under ``name``; it appears whole or not at all.

        A task that runs again writes the same bytes and replaces the file.
        """
        self._fs.create_dir(self._root, recursive=True)
        draft = f"{self._root}/.{name}-{uuid.uuid4().hex}"
        with self._fs.open_output_stream(draft) as out:
            for part in parts:
                out.write(part)
        self._fs.move(draft, f"{self._root}/{name}")

    def open(self, name: str):
        return self._fs.open_input_file(f"{self._root}/{name}")
