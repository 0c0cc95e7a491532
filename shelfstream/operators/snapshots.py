"""The latest count per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstream.operators.ranking import first_per_key

SNAPSHOT_KEY = ["store_id", "item_id"]
SEQUENCE = "date_time"
# Counts of one moment: the larger quantity, then the larger employee id, is kept.
TIE_BREAK = ["quantity", "employee_id"]


def latest_by_key(
    df: DataFrame, keys: list[str], sequence_by: str, tie_break: list[str] | None = None
) -> DataFrame:
    """The row with the greatest ``sequence_by`` per key.

    Equal values are decided by ``tie_break``, then by the other columns, so reruns
    agree. A NULL never replaces a value.
    """
    first = [sequence_by, *(tie_break or [])]
    rest = [c for c in df.columns if c not in (*keys, *first)]
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in (*first, *rest)])


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The latest count per (store, item)."""
    return latest_by_key(snapshots, SNAPSHOT_KEY, SEQUENCE, TIE_BREAK)


def snapshot_of_store(snapshots: DataFrame, store_id: int) -> DataFrame:
    """The counts of one store."""
    return snapshots.filter(F.col("store_id") == store_id)


def snapshot_at(snapshots: DataFrame, store_id: int, date_time: str) -> DataFrame:
    """The counts of one store at one time."""
    return snapshot_of_store(snapshots, store_id).filter(
        F.col("date_time") == F.lit(date_time).cast("timestamp")
    )
