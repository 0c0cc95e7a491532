"""The change stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from shelfstream.operators.changes import dedup_changes, flatten_events, parse_events


def change_stream(raw: DataFrame, delay: str = "1 hour", mode: str = "exact") -> DataFrame:
    """Messages to deduplicated item-level changes."""
    return dedup_changes(flatten_events(parse_events(raw)), delay, mode)


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Run every ``interval``, or once over all that is there and stop."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    partition_by: list[str] | None = None,
    write_tasks: int | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet files, each row once.

    A stateful stream writes a file per state partition and micro-batch. Where these get
    small, ``write_tasks`` says how many tasks write.
    """
    if write_tasks:
        stream = stream.repartition(write_tasks)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return triggered(writer, interval).start()
