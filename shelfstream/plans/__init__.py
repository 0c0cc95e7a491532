"""How the operators are wired into datasets."""

from shelfstream.plans.retail import (
    DATASETS,
    Layout,
    gold_datasets,
    name_streamed_datasets,
    read_change_counts,
    read_day_sums,
    read_latest_snapshots,
    read_raw_stream,
    read_silver_changes,
    read_silver_snapshots,
    refresh_dimensions,
    refresh_gold,
    silver_changes,
    start_change_streams,
    start_raw_stream,
    start_refreshes,
    start_snapshot_streams,
    start_streams,
    streamed_inventory,
)

__all__ = [
    "DATASETS",
    "Layout",
    "gold_datasets",
    "name_streamed_datasets",
    "read_change_counts",
    "read_day_sums",
    "read_latest_snapshots",
    "read_raw_stream",
    "read_silver_changes",
    "read_silver_snapshots",
    "refresh_dimensions",
    "refresh_gold",
    "silver_changes",
    "start_change_streams",
    "start_raw_stream",
    "start_refreshes",
    "start_snapshot_streams",
    "start_streams",
    "streamed_inventory",
]
