"""Batch and streaming readers."""

from shelfstream.sources.files import (
    read_change_type,
    read_changes,
    read_item,
    read_landed_snapshots,
    read_snapshot_stream,
    read_snapshots,
    read_store,
)
from shelfstream.sources.messages import kafka_options, read_change_stream
from shelfstream.sources.tables import read_dataset, read_dataset_stream

__all__ = [
    "kafka_options",
    "read_change_stream",
    "read_change_type",
    "read_changes",
    "read_dataset",
    "read_dataset_stream",
    "read_item",
    "read_landed_snapshots",
    "read_snapshot_stream",
    "read_snapshots",
    "read_store",
]
