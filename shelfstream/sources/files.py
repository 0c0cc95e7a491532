"""CSV readers: header line, declared schema, columns bound by position."""

from __future__ import annotations

import functools
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream import schemas
from shelfstream.local_files import below, csv_lines
from shelfstream.storage import local_path

# Files of a micro-batch, so that a backlog comes in parts.
MAX_FILES = 1_000


def _csv(spark: SparkSession, path: str | list[str], schema: str, **options) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, **options)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.STORE)


def read_item(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.ITEM)


def read_change_type(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.CHANGE_TYPE)


def read_changes(
    spark: SparkSession,
    paths: str | list[str],
    timestamp_format: str = schemas.SECOND_FORMAT,
) -> DataFrame:
    """Change lines of all the files, as one table."""
    return _csv(spark, paths, schemas.CHANGE_LINE, timestampFormat=timestamp_format)


def read_snapshots(
    spark: SparkSession,
    paths: str | list[str],
    timestamp_format: str = schemas.SECOND_FORMAT,
) -> DataFrame:
    """Counts of all the files, as one table."""
    return _csv(spark, paths, schemas.SNAPSHOT, timestampFormat=timestamp_format)


_STORE_FOLDER = re.compile(r"store=([+-]?[0-9]+|__HIVE_DEFAULT_PARTITION__)")
# Larger files are left to Spark's reader, which reads parts of them side by side.
_LARGE = 128 << 20


def _store_folders(spark: SparkSession, path: str) -> list[str]:
    """Local names of the store folders; none where there is anything else beside them."""
    root = local_path(spark, path)
    if root is None or not os.path.isdir(root) or re.search(r"[*?{\[\\]", path):
        return []
    folders = below(root)
    stores = all(_STORE_FOLDER.fullmatch(os.path.basename(f)) for f in folders)
    return folders if stores else []


def _read_by_tasks(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """The rows of :func:`_csv`, where tasks can read the files themselves."""
    lines, large = csv_lines(spark, folders, _LARGE)
    parts = []
    if lines is not None:
        row = F.from_csv("line", schemas.LANDED_SNAPSHOT).alias("row")
        parts.append(lines.select(row).select("row.*"))
    if large:
        parts.append(_csv(spark, [f"file://{f}" for f in large], schemas.LANDED_SNAPSHOT))
    return functools.reduce(DataFrame.unionByName, parts) if parts else None


def read_landed_snapshots(
    spark: SparkSession, path: str, store_id: int | None = None, date_time: str | None = None
) -> DataFrame:
    """Counts that were landed one folder per (store, time); the row index is dropped.

    ``store_id`` and ``date_time`` (in :data:`~shelfstream.schemas.SECOND_FORMAT`) limit what
    is read to the folders of that store and time. A whole read of local folders is left to
    tasks: there may be a file per store and second.
    """
    if store_id is None and date_time is None and (folders := _store_folders(spark, path)):
        whole = _read_by_tasks(spark, folders)
        if whole is not None:
            return whole.drop("id")
    landed = _csv(spark, path, f"{schemas.LANDED_SNAPSHOT}, store int, taken string")
    if store_id is not None:
        landed = landed.filter(F.col("store") == store_id)
    if date_time is not None:
        landed = landed.filter(F.col("taken") == date_time)
    return landed.drop("id", "store", "taken")


def read_snapshot_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = MAX_FILES
) -> DataFrame:
    """Counts as their files arrive, files that are already there included.

    A micro-batch reads ``max_files_per_trigger`` files at most, None for no limit.
    """
    reader = (
        spark.readStream.schema(schemas.LANDED_SNAPSHOT)
        .option("header", True)
        .option("recursiveFileLookup", True)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path).drop("id")
