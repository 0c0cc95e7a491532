"""Retail inventory analytics on Spark: change messages and stock counts to current stock."""

from shelfstream.operators.changes import (
    changes_of,
    dedup_changes,
    effective_changes,
    flatten_events,
    malformed_changes,
    parse_events,
)
from shelfstream.operators.inventory import (
    current_inventory,
    current_inventory_by_quantity,
    distinct_items,
    inventory_for_bi,
    newest_first,
    recent_changes,
)
from shelfstream.operators.snapshots import (
    latest_by_key,
    latest_snapshot,
    snapshot_at,
    snapshot_of_store,
)
from shelfstream.operators.timeline import event_gaps, snapshot_release, snapshot_times
from shelfstream.operators.transactions import (
    assemble_first_transactions,
    assemble_transactions,
    first_transactions,
    split_documents,
    split_lines,
    strip_braces,
    to_documents,
)
from shelfstream.sinks import publish, save_dataset, write_snapshot_files
from shelfstream.streaming import upsert_latest

__all__ = [
    "assemble_first_transactions",
    "assemble_transactions",
    "changes_of",
    "current_inventory",
    "current_inventory_by_quantity",
    "dedup_changes",
    "distinct_items",
    "effective_changes",
    "event_gaps",
    "first_transactions",
    "flatten_events",
    "inventory_for_bi",
    "latest_by_key",
    "latest_snapshot",
    "malformed_changes",
    "newest_first",
    "parse_events",
    "publish",
    "recent_changes",
    "save_dataset",
    "snapshot_at",
    "snapshot_of_store",
    "snapshot_release",
    "snapshot_times",
    "split_documents",
    "split_lines",
    "strip_braces",
    "to_documents",
    "upsert_latest",
    "write_snapshot_files",
]
