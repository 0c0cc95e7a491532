"""Change messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_envelope(documents: DataFrame, topic: str = "inventory_change") -> DataFrame:
    """Documents in the message envelope, for readers that have no message broker.

    The offset is unique, increases within a partition and leaves gaps.
    """
    header = "array<struct<key: string, value: binary>>"
    return documents.select(
        F.col("trans_id").cast("binary").alias("key"),
        F.col("document").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.col("date_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.lit(None).cast(header).alias("headers"),
    )


def publish(documents: DataFrame, sink: str, options: dict[str, str]) -> None:
    """Send documents to a topic (``sink="kafka"``) or to JSON lines (``sink="text"``).

    The transaction id is the message key. For text, ``path`` is among the options and
    what is there is replaced.
    """
    if sink == "kafka":
        messages = documents.select(
            F.col("trans_id").alias("key"), F.col("document").alias("value")
        )
        messages.write.format("kafka").options(**options).save()
    elif sink == "text":
        lines = documents.select(F.col("document").alias("value"))
        lines.write.mode("overwrite").format("text").options(**options).save()
    else:
        raise ValueError(f"unknown sink {sink!r}")
