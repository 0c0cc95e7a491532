"""Groups that a stream keeps in its state, and that state read as a table.

A streaming aggregation holds one row per group in its state store, in the checkpoint. In update
mode a micro-batch changes only the groups it has rows of. The state is all there is to keep:
nothing is written per micro-batch, and no reader has to add up parts or go through history.
Old versions of the state are dropped by Spark, so what is listed does not grow with time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfstream.operators.inventory import count_changes, day_sums
from shelfstream.schemas import struct_type
from shelfstream.storage import child_names
from shelfstream.streaming.changes import triggered

OnChange = Callable[[DataFrame, int], None]

CHANGE_COUNT = "item_id int, change_type_id int, n bigint"
DAY_SUM = (
    "store_id int, item_id int, change_type_id int, event_date date, moved bigint, moved_at timestamp"
)


def keep_groups(
    groups: DataFrame, checkpoint: str, interval: str | None = None, on_change: OnChange | None = None
) -> StreamingQuery:
    """Keep the groups of a streaming aggregation in the state below ``checkpoint``.

    ``on_change`` is called with the groups a micro-batch has changed, as they are now, and the
    batch's number; a batch that is run again has the same number and the same groups.
    """
    writer = groups.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(on_change) if on_change else writer.format("noop")
    return triggered(writer, interval).start()


def read_groups(spark: SparkSession, checkpoint: str, keys: str, values: str) -> DataFrame:
    """All groups as of the last finished micro-batch; none before the first.

    ``keys`` and ``values`` are the columns of the grouping and of the aggregates, in order. The
    aggregates must be such that their buffer is their result (count, min, max, sum of integers).
    """
    of_keys, of_values = struct_type(keys), struct_type(values)
    if not child_names(spark, f"{checkpoint}/commits"):
        return spark.createDataFrame([], struct_type(f"{keys}, {values}"))
    state = spark.read.format("statestore").load(checkpoint)

    def named(part: str, fields) -> list:
        stored = state.schema[part].dataType.fieldNames()
        return [
            F.col(f"{part}.{name}").cast(f.dataType).alias(f.name)
            for name, f in zip(stored, fields, strict=True)
        ]

    return state.select(*named("key", of_keys), *named("value", of_values))


def latest_groups(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row that is greatest by ``order``, then by the other columns; NULL is least."""
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("latest"))


def keep_latest(
    rows: DataFrame,
    keys: list[str],
    sequence_by: str,
    checkpoint: str,
    tie_break: list[str] | None = None,
    interval: str | None = None,
    on_change: OnChange | None = None,
) -> StreamingQuery:
    """Keep the row with the greatest ``sequence_by`` per key of a stream.

    The rows are those :func:`~shelfstream.operators.snapshots.latest_by_key` takes from the
    whole history: an older row that comes late changes nothing, a NULL never replaces a
    value, NULL keys are one key. ``on_change`` gets the latest rows of the keys that a
    micro-batch has rows of.
    """

    def rows_of(changed: DataFrame, batch_id: int) -> None:
        on_change(changed.select(*keys, "latest.*").select(*rows.columns), batch_id)

    latest = latest_groups(rows, keys, [sequence_by, *(tie_break or [])])
    return keep_groups(latest, checkpoint, interval, rows_of if on_change else None)


def read_latest(
    spark: SparkSession, checkpoint: str, schema: str, keys: list[str], sequence_by: str,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The rows that :func:`keep_latest` holds; ``schema`` has all their columns."""
    fields = {f.name: f for f in struct_type(schema)}
    first = [*keys, sequence_by, *(tie_break or [])]
    order = [c for c in (*first, *fields) if c not in keys]
    order = list(dict.fromkeys(order))
    ddl = lambda names: ", ".join(f"{n} {fields[n].dataType.simpleString()}" for n in names)
    latest = f"latest struct<{', '.join(f'{n}: {fields[n].dataType.simpleString()}' for n in order)}>"
    return read_groups(spark, checkpoint, ddl(keys), latest).select(*keys, "latest.*").select(*fields)


def keep_change_counts(
    changes: DataFrame, checkpoint: str, interval: str | None = None, on_change: OnChange | None = None
) -> StreamingQuery:
    """Keep the number of streamed changes per (item, change type)."""
    return keep_groups(count_changes(changes), checkpoint, interval, on_change)


def read_kept_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    keys, value = CHANGE_COUNT.rsplit(", ", 1)
    return read_groups(spark, checkpoint, keys, value)


def keep_day_sums(
    changes: DataFrame, checkpoint: str, interval: str | None = None, on_change: OnChange | None = None
) -> StreamingQuery:
    """Keep what streamed changes moved per (store, item, change type) and day."""
    return keep_groups(day_sums(changes), checkpoint, interval, on_change)


def read_kept_sums(spark: SparkSession, checkpoint: str) -> DataFrame:
    parts = DAY_SUM.split(", ")
    return read_groups(spark, checkpoint, ", ".join(parts[:4]), ", ".join(parts[4:]))
