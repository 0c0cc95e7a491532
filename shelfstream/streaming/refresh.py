"""Tables that are recomputed from time to time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfstream.streaming.changes import triggered


def refresh_with(
    stream: DataFrame,
    recompute: Callable[[], None],
    checkpoint: str,
    interval: str | None = "1 minute",
) -> StreamingQuery:
    """Call ``recompute`` after each micro-batch of ``stream``.

    Current inventory is recomputed from the silver tables as they stand, not joined
    stream to stream: a later count replaces what an earlier one led to.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        recompute()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()


def refresh_every(
    spark: SparkSession, recompute: Callable[[], None], checkpoint: str, interval: str
) -> StreamingQuery:
    """Call ``recompute`` every ``interval``, whatever else happens."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return refresh_with(ticks, recompute, checkpoint, interval)
