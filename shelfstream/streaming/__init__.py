"""Structured Streaming forms of the operators."""

from shelfstream.streaming.account import Account, account_of, accounted_changes
from shelfstream.streaming.changes import append_stream, change_stream
from shelfstream.streaming.refresh import refresh_every, refresh_with
from shelfstream.streaming.snapshots import merge_statement, upsert_latest
from shelfstream.streaming.state import (
    keep_change_counts,
    keep_day_sums,
    keep_groups,
    keep_latest,
    read_groups,
    read_kept_counts,
    read_kept_sums,
    read_latest,
)

__all__ = [
    "Account",
    "account_of",
    "accounted_changes",
    "append_stream",
    "change_stream",
    "keep_change_counts",
    "keep_day_sums",
    "keep_groups",
    "keep_latest",
    "merge_statement",
    "read_groups",
    "read_kept_counts",
    "read_kept_sums",
    "read_latest",
    "refresh_every",
    "refresh_with",
    "upsert_latest",
]
