"""Where work that must outlive a task is written."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# The temporary folder of a local session that names none.
_SCRATCH = "spark.shelfstream.scratch"
_made: list[tempfile.TemporaryDirectory] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only when the session runs in local
    mode and names none, and removed when Python ends; on a cluster a missing setting is an
    error, since a folder of one machine does not survive the loss of that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_SCRATCH, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.TemporaryDirectory(prefix="shelfstream-", ignore_cleanup_errors=True)
    _made.append(made)
    spark.conf.set(_SCRATCH, made.name)
    return made.name


def warehouse_dir(spark: SparkSession) -> str:
    """Where tables without a location go; on a cluster it must have been named."""
    place = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    default = place.removeprefix("file:") == f"{os.getcwd()}/spark-warehouse"
    if default and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.sql.warehouse.dir to a folder shared by all executors")
    return place


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def local_path(spark: SparkSession, path: str) -> str | None:
    """The name ``path`` has without Hadoop; None when it is not in a local or mounted folder."""
    fs, hadoop_path = _file_system(spark, path)
    if fs.getUri().getScheme() != "file":
        return None
    return fs.makeQualified(hadoop_path).toUri().getPath()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, hadoop_path = _file_system(spark, path)
    fs.create(hadoop_path).close()


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)
