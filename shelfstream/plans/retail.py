"""The inventory datasets, from files and messages to the report table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfstream import schemas
from shelfstream.operators.changes import (
    dedup_changes,
    effective_changes,
    effective_sums,
    flatten_events,
    parse_events,
)
from shelfstream.operators.inventory import (
    changes_of_counted_days,
    current_inventory,
    current_inventory_of_sums,
    inventory_for_bi,
    inventory_for_bi_of_counts,
    recent_changes,
)
from shelfstream.operators.snapshots import SEQUENCE, SNAPSHOT_KEY, TIE_BREAK
from shelfstream.sinks.tables import save_dataset, save_view
from shelfstream.sources.files import MAX_FILES, read_change_type, read_item, read_store
from shelfstream.sources.messages import read_change_stream
from shelfstream.storage import child_names, make_dir
from shelfstream.streaming.changes import append_stream
from shelfstream.streaming.refresh import refresh_every
from shelfstream.streaming.state import (
    keep_change_counts,
    keep_day_sums,
    keep_latest,
    read_kept_counts,
    read_kept_sums,
    read_latest,
)

# Dataset names and quality levels. The comments are ours.
DATASETS = {
    "store": ("stores, the online store among them", "silver"),
    "item": ("items and their safety stock", "silver"),
    "inventory_change_type": ("what the change type ids stand for", "silver"),
    "raw_inventory_change": ("change messages as they arrived", "bronze"),
    "inventory_change": ("changes per item, each once", "silver"),
    "inventory_snapshot": ("all counts", "silver"),
    "latest_inventory_snapshot": ("the latest count per store and item", "silver"),
    "inventory_current": ("the latest count and what moved since", "gold"),
    "inventory_current_transformed": ("current inventory in the form of the report", "gold"),
}
# How often datasets are refreshed.
DIMENSION_INTERVAL = "24 hours"
GOLD_INTERVAL = "1 minute"


_CHANGE_TABLE = f"{schemas.CHANGE}, event_date date"


@dataclass(frozen=True)
class Layout:
    """Folders of the streamed datasets, below one shared folder.

    What is kept in the state of a stream lies in its checkpoint: the latest counts, and the
    numbers and sums of the changes.
    """

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_inventory_change"

    @property
    def changes(self) -> str:
        return f"{self.root}/inventory_change"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/inventory_snapshot"

    def checkpoint(self, dataset: str) -> str:
        return f"{self.root}/_checkpoints/{dataset}"


def _save(df: DataFrame, database: str, dataset: str, location: str | None = None) -> None:
    comment, quality = DATASETS[dataset]
    place = f"{location}/{dataset}" if location else None
    save_dataset(df, f"{database}.{dataset}", comment, {"quality": quality}, place)


def refresh_dimensions(
    spark: SparkSession, database: str, stores: str, items: str, change_types: str
) -> None:
    """Rewrite the three dimension tables from their files (every 24 hours)."""
    _save(read_store(spark, stores), database, "store")
    _save(read_item(spark, items), database, "item")
    _save(read_change_type(spark, change_types), database, "inventory_change_type")


def silver_changes(raw: DataFrame) -> DataFrame:
    """Item-level changes of a batch of messages."""
    return dedup_changes(flatten_events(parse_events(raw)))


def _dated(changes: DataFrame) -> DataFrame:
    return changes.withColumn("event_date", F.to_date("date_time"))


def start_raw_stream(
    raw: DataFrame, layout: Layout, interval: str | None = None
) -> StreamingQuery:
    """Messages as they arrived, so that the source is read once."""
    checkpoint = layout.checkpoint("raw_inventory_change")
    return append_stream(raw, layout.raw, checkpoint, interval)


def read_raw_stream(spark: SparkSession, layout: Layout) -> DataFrame:
    """The stored messages; a micro-batch reads ``MAX_FILES`` files of them at most."""
    make_dir(spark, layout.raw)
    options = {"path": layout.raw, "maxFilesPerTrigger": str(MAX_FILES)}
    return read_change_stream(spark, "parquet", options)


def start_change_streams(
    raw: DataFrame,
    layout: Layout,
    interval: str | None = None,
    keep_event: bool = False,
    write_tasks: int | None = None,
) -> list[StreamingQuery]:
    """Changes, each (transaction, item) once whatever the time of a resend, and what is kept of them.

    The change table is partitioned by event date, so that a refresh of current inventory
    reads the days of the latest counts only. Undated changes are a partition of their own. Two
    streams follow the table: the number of changes per (item, change type), for the report,
    and their sums per (store, item, change type) and day, for current inventory.
    """
    flat = flatten_events(parse_events(raw), keep_event)
    changes = append_stream(
        _dated(dedup_changes(flat)),
        layout.changes,
        layout.checkpoint("inventory_change"),
        interval,
        ["event_date"],
        write_tasks,
    )
    if interval is None:
        changes.awaitTermination()
    spark = raw.sparkSession
    stored = _follow(spark, layout.changes, _CHANGE_TABLE)
    return [
        changes,
        keep_change_counts(stored, layout.checkpoint("change_counts"), interval),
        keep_day_sums(stored, layout.checkpoint("day_sums"), interval),
    ]


def _follow(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The stream of a stored dataset; a micro-batch reads ``MAX_FILES`` files of it at most."""
    make_dir(spark, path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", MAX_FILES).parquet(path)


def start_snapshot_streams(
    snapshots: DataFrame, layout: Layout, interval: str | None = None
) -> list[StreamingQuery]:
    """All counts, as they come, and the latest per (store, item), kept as they come."""
    history = append_stream(
        snapshots, layout.snapshots, layout.checkpoint("inventory_snapshot"), interval
    )
    if interval is None:
        history.awaitTermination()
    stored = _follow(snapshots.sparkSession, layout.snapshots, schemas.SNAPSHOT)
    checkpoint = layout.checkpoint("latest_inventory_snapshot")
    return [history, keep_latest(stored, SNAPSHOT_KEY, SEQUENCE, checkpoint, TIE_BREAK, interval)]


def start_streams(
    raw: DataFrame,
    snapshots: DataFrame,
    layout: Layout,
    interval: str | None = None,
    keep_event: bool = False,
    write_tasks: int | None = None,
) -> list[StreamingQuery]:
    """Start the bronze and silver streams.

    With no ``interval`` they stop when all is read; the messages are then stored before
    the streams that read them start. ``keep_event`` adds the whole event to each change.
    ``write_tasks`` is for short intervals: fewer, larger files of changes.
    """
    messages = start_raw_stream(raw, layout, interval)
    if interval is None:
        messages.awaitTermination()
    stored = read_raw_stream(raw.sparkSession, layout)
    return [
        messages,
        *start_change_streams(stored, layout, interval, keep_event, write_tasks),
        *start_snapshot_streams(snapshots, layout, interval),
    ]


def start_refreshes(
    spark: SparkSession,
    database: str,
    layout: Layout,
    stores: str,
    items: str,
    change_types: str,
    dimension_interval: str = DIMENSION_INTERVAL,
    gold_interval: str = GOLD_INTERVAL,
    compact: bool = False,
) -> list[StreamingQuery]:
    """Keep the dimension and the gold tables up to date until the queries are stopped.

    They may start before any stream has written a row. The dimensions are read once
    before, since gold needs them.
    """

    def dimensions() -> None:
        refresh_dimensions(spark, database, stores, items, change_types)

    def gold() -> None:
        refresh_gold(spark, database, layout, compact)

    dimensions()
    return [
        refresh_every(spark, dimensions, layout.checkpoint("dimensions"), dimension_interval),
        refresh_every(spark, gold, layout.checkpoint("gold"), gold_interval),
    ]


def name_streamed_datasets(spark: SparkSession, database: str, layout: Layout) -> None:
    """Make the streamed datasets that have rows readable by name."""
    folders = {
        "raw_inventory_change": layout.raw,
        "inventory_change": layout.changes,
        "inventory_snapshot": layout.snapshots,
    }
    for dataset, path in folders.items():
        if any(not name.startswith("_") for name in child_names(spark, path)):
            comment, quality = DATASETS[dataset]
            save_view(spark, path, f"{database}.{dataset}", comment, {"quality": quality})


def read_silver_changes(spark: SparkSession, layout: Layout) -> DataFrame:
    """The streamed changes; none before the first has come."""
    return _read_streamed(spark, layout.changes, _CHANGE_TABLE)


def read_change_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Streamed changes per (item, change type)."""
    return read_kept_counts(spark, layout.checkpoint("change_counts"))


def read_day_sums(spark: SparkSession, layout: Layout) -> DataFrame:
    """What streamed changes moved per (store, item, change type) and day."""
    return read_kept_sums(spark, layout.checkpoint("day_sums"))


def read_latest_snapshots(spark: SparkSession, layout: Layout) -> DataFrame:
    """The latest streamed count per (store, item)."""
    checkpoint = layout.checkpoint("latest_inventory_snapshot")
    return read_latest(spark, checkpoint, schemas.SNAPSHOT, SNAPSHOT_KEY, SEQUENCE, TIE_BREAK)


def read_silver_snapshots(spark: SparkSession, layout: Layout) -> DataFrame:
    """All streamed counts; none before the first has come."""
    return _read_streamed(spark, layout.snapshots, schemas.SNAPSHOT)


def _read_streamed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    make_dir(spark, path)
    return spark.read.schema(schema).parquet(path)


def gold_datasets(
    changes: DataFrame, latest: DataFrame, stores: DataFrame, change_types: DataFrame
) -> dict[str, DataFrame]:
    """The gold datasets over silver ones.

    Current inventory reads changes from the oldest latest count on; the report counts
    all changes of an item, so it reads them all.
    """
    recent = recent_changes(changes, latest)
    current = current_inventory(latest, effective_changes(recent, stores, change_types))
    return {
        "inventory_current": current,
        "inventory_current_transformed": inventory_for_bi(current, changes, change_types),
    }


def refresh_gold(
    spark: SparkSession, database: str, layout: Layout, compact: bool = False,
    location: str | None = None,
) -> None:
    """Rewrite the gold tables from silver (every minute), below ``location`` if given.

    The latest counts, and the numbers and daily sums of the changes, come from the state of
    their streams. No count of the history is read, and of the changes only those of the days
    on which a latest count was taken. Current inventory is stored first and the report reads
    the stored table, so it is computed once; it grows with the number of changes, and
    ``compact`` stores a count in place of repeated rows.
    """
    name_streamed_datasets(spark, database, layout)
    _save(read_latest_snapshots(spark, layout), database, "latest_inventory_snapshot", location)
    latest = spark.table(f"{database}.latest_inventory_snapshot")
    stores = spark.table(f"{database}.store")
    change_types = spark.table(f"{database}.inventory_change_type")
    current = streamed_inventory(spark, layout, latest, stores, change_types)
    _save(current, database, "inventory_current", location)
    current = spark.table(f"{database}.inventory_current")
    counted = read_change_counts(spark, layout)
    report = inventory_for_bi_of_counts(current, counted, change_types, compact)
    _save(report, database, "inventory_current_transformed", location)


def streamed_inventory(
    spark: SparkSession, layout: Layout, latest: DataFrame, stores: DataFrame, change_types: DataFrame
) -> DataFrame:
    """Current inventory from the kept sums, and from the changes of the days of the counts."""
    days = changes_of_counted_days(read_silver_changes(spark, layout), latest)
    return current_inventory_of_sums(
        latest,
        effective_sums(read_day_sums(spark, layout), stores, change_types),
        effective_changes(days, stores, change_types),
    )
