"""Named tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfstream.storage import child_names, remove_dir, warehouse_dir


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop the database with its tables; files of its tables stay."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"USE {name}")


# Folders of one table, in the order of their writing.
_RUN = "run="


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _settings(properties: dict[str, str]) -> str:
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    return f"TBLPROPERTIES ({pairs})" if pairs else ""


def save_dataset(
    df: DataFrame,
    name: str,
    comment: str,
    properties: dict[str, str],
    location: str | None = None,
    partition_by: list[str] | None = None,
    keep_hours: float = 24,
) -> None:
    """Write ``df`` as the table ``name``, replacing its rows.

    Rows go to a new folder under ``location`` first and the table is pointed at it when
    they are complete: a write that fails, or a query that reads the table meanwhile,
    finds the rows from before. A folder stays for ``keep_hours`` after the next one replaced
    it, which must be more than the longest query takes.
    """
    spark = df.sparkSession
    base = location or f"{warehouse_dir(spark)}/datasets/{name}"
    folder = f"{base}/{_RUN}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(folder)

    settings = _settings(properties)
    if spark.catalog.tableExists(name) and not _same_columns(spark, name, df):
        spark.sql(f"DROP TABLE {name}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(folder)}")
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
        if settings:
            spark.sql(f"ALTER TABLE {name} SET {settings}")
    else:
        spark.sql(
            f"CREATE TABLE {name} USING parquet LOCATION {_quoted(folder)} "
            f"COMMENT {_quoted(comment)} {settings}"
        )
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)

    runs = [child for child in child_names(spark, base) if child.startswith(_RUN)]
    limit = time.time_ns() - int(keep_hours * 3600e9)
    for old, after in zip(runs, runs[1:], strict=False):
        if int(after.removeprefix(_RUN).split("-")[0]) < limit:
            remove_dir(spark, f"{base}/{old}")


def save_view(
    spark: SparkSession, path: str, name: str, comment: str, properties: dict[str, str]
) -> None:
    """Give the Parquet files that a stream keeps adding to under ``path`` a name."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} COMMENT {_quoted(comment)} {_settings(properties)} "
        f"AS SELECT * FROM parquet.`{path}`"
    )


def _same_columns(spark: SparkSession, name: str, df: DataFrame) -> bool:
    def columns(schema):
        return sorted((f.name, f.dataType.simpleString()) for f in schema.fields)

    return columns(spark.table(name).schema) == columns(df.schema)
