"""The latest row per key, merged into a table.

For catalogs that have tables with row-level changes. Elsewhere the latest rows are kept in
the state of a stream (:func:`~shelfstream.streaming.state.keep_latest`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfstream.operators.snapshots import latest_by_key
from shelfstream.streaming.changes import triggered


def merge_statement(table: str, source: str, keys: list[str], order: list[str]) -> str:
    """Replace a row of ``table`` by the row of ``source`` that has its key and beats it.

    Columns of ``order`` decide one after the other; a NULL never beats a value. NULL keys
    are one key.
    """
    same = " AND ".join(f"t.{k} <=> s.{k}" for k in keys)
    beats = "false"
    for c in reversed(order):
        more = f"s.{c} > t.{c} OR (s.{c} IS NOT NULL AND t.{c} IS NULL)"
        beats = f"({more} OR (s.{c} <=> t.{c} AND {beats}))"
    return (
        f"MERGE INTO {table} AS t USING {source} AS s ON {same} "
        f"WHEN MATCHED AND {beats} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def upsert_latest(
    stream: DataFrame,
    table: str,
    keys: list[str],
    sequence_by: str,
    checkpoint: str,
    tie_break: list[str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep, in ``table``, the row with the greatest ``sequence_by`` per key.

    The table's format must support MERGE. A micro-batch that is run again changes nothing.
    """
    order = [sequence_by, *(tie_break or [])]

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"_latest_{batch_id}"
        latest_by_key(batch, keys, sequence_by, tie_break).createOrReplaceTempView(name)
        batch.sparkSession.sql(merge_statement(table, name, keys, order))
        batch.sparkSession.catalog.dropTempView(name)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()
