"""Count files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.functions import as_second_text
from shelfstream.local_files import line_writer
from shelfstream.storage import local_path, make_dir, make_file, remove_dir

_TAKEN = ["store_id", "date_time"]
_FOLDERS = ["store", "taken"]
# monotonically_increasing_id keeps the position within its task in the low 33 bits.
_POSITION = (1 << 33) - 1


_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


@contextmanager
def _apart(spark: SparkSession) -> Iterator[None]:
    """Small shuffle partitions stay apart meanwhile."""
    before = spark.conf.get(_COALESCE)
    spark.conf.set(_COALESCE, "false")
    try:
        yield
    finally:
        spark.conf.set(_COALESCE, before)


def _write_by_spark(files: DataFrame, path: str) -> None:
    (
        files.write.mode("overwrite")
        .partitionBy(*_FOLDERS)
        .option("header", True)
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .csv(path)
    )


def _write_by_tasks(files: DataFrame, path: str, root: str) -> None:
    """The files :func:`_write_by_spark` makes, where tasks can write them themselves."""
    spark = files.sparkSession
    columns = [c for c in files.columns if c not in _FOLDERS]
    # As for Spark's writer, an empty text is no value.
    folders = {c: F.nullif(F.col(c).cast("string"), F.lit("")) for c in _FOLDERS}
    lines = (
        files.withColumns(folders)
        .sortWithinPartitions(*_FOLDERS, "id")
        .select(*_FOLDERS, F.to_csv(F.struct(*columns)).alias("line"))
    )
    job = str(uuid.uuid4())
    scratch = f"_temporary-{job}"
    remove_dir(spark, path)
    make_dir(spark, path)
    try:
        write = line_writer(root, f"{root}/{scratch}", job, ",".join(columns))
        lines.mapInArrow(write, "line string").write.format("noop").mode("overwrite").save()
    finally:
        remove_dir(spark, f"{path}/{scratch}")
    make_file(spark, f"{path}/_SUCCESS")


def write_snapshot_files(snapshots: DataFrame, path: str) -> None:
    """Write counts as CSV, one folder per (store, time), replacing what is there.

    One Spark job makes all the files. Rows of a folder are brought together; a count
    much larger than the others is rebalanced over several tasks and so has several files.
    Many small counts are dealt over all partitions of the shuffle, since each takes a file
    however few its rows, and every task puts its own files in place: the driver moves none.
    A write that fails leaves no ``_SUCCESS``, but may leave files.
    Files have a header and, as first column, a row index that readers drop: the position
    in the task that wrote it, increasing within a file. Store and time stay in the files
    besides naming the folders.
    """
    placed = snapshots.hint("rebalance", *_TAKEN)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))
    taken = as_second_text("date_time")
    files = placed.select(
        position.alias("id"),
        "item_id",
        "employee_id",
        "store_id",
        taken.alias("date_time"),
        "quantity",
        F.col("store_id").alias("store"),
        taken.alias("taken"),
    )
    spark = snapshots.sparkSession
    root = local_path(spark, path)
    with _apart(spark):
        if root is None:
            _write_by_spark(files, path)
        else:
            _write_by_tasks(files, path, root)
